import pytest
from pyspark.sql import functions as F

from shiftlake.sinks import jdbc, keyed, topics
from shiftlake.sinks.files import ControlFiles


def rows_of(table, *columns):
    return sorted(map(tuple, table.read(columns).collect()), key=repr)


def put(spark, table, rows, schema="row_key string, day_date string, a string, b string, seq int", **kw):
    return table.put(spark.createDataFrame(rows, schema), **kw)


def test_put_merges_and_null_does_not_erase(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), partition="day_date")
    assert table.read() is None
    put(spark, table, [("k1", "d1", "1", None, 1), ("k1", "d1", None, "2", 2), ("k2", "d2", "x", "y", 3)], order=["seq"])
    put(spark, table, [("k1", "d1", "9", None, 4), (None, "d1", "z", "z", 5)], order=["seq"])
    assert rows_of(table, "row_key", "a", "b") == [("k1", "9", "2"), ("k2", "x", "y")]


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), partition="day_date")
    put(spark, table, [("k1", "d1", "1", "1", 1), ("k2", "d2", "2", "2", 2)], order=["seq"])
    before = table.manifest()["parts"]
    put(spark, table, [("k2", "d2", "3", None, 3)], order=["seq"])
    after = table.manifest()["parts"]
    assert before["_part=d1"] == after["_part=d1"] and before["_part=d2"] != after["_part=d2"]


def test_replay_changes_nothing(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"))
    assert put(spark, table, [("k", "d", "1", "1", 1)], order=["seq"], batch_id=7)
    version = table.manifest()["version"]
    assert not put(spark, table, [("k", "d", "other", "1", 1)], order=["seq"], batch_id=7)
    assert table.manifest()["version"] == version and rows_of(table, "a") == [("1",)]


def test_vacuum_keeps_what_is_in_use(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), partition="day_date")
    for day in ("d1", "d2", "d2", "d2"):
        put(spark, table, [("k" + day, day, "1", "1", 1)], order=["seq"])
    table.vacuum(keep=1)
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "t" / "data").iterdir()) == ["v0000000001", "v0000000004"]
    assert rows_of(table, "row_key") == [("kd1",), ("kd2",)]


def test_new_columns_and_delete(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"))
    put(spark, table, [("k1", "1")], "row_key string, a string")
    put(spark, table, [("k1", "n"), ("k2", "m")], "row_key string, extra string")
    assert rows_of(table, "row_key", "a", "extra") == [("k1", "1", "n"), ("k2", None, "m")]
    gone = spark.createDataFrame([("k1",), ("k1",)], "row_key string")
    keyed.put_records(table, gone, operation=keyed.DELETE)
    assert rows_of(table, "row_key") == [("k2",)]
    with pytest.raises(ValueError):
        keyed.put_records(table, gone, operation="MERGE")


def test_converter_and_map_columns(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([("k", {"x": "1", "y": None}), ("l", {"z": "2"})], "row_key string, rec map<string,string>")
    keyed.put_records(table, df, convert=keyed.columns_of_map)
    assert rows_of(table, "row_key", "x", "y", "z") == [("k", "1", None, None), ("l", None, None, "2")]


def test_routed_tables(spark, tmp_path):
    rows = [("ta", "k1", "d", 1, {"v": "1"}), ("tb", "k1", "d", 2, {"w": "2"}), ("ta", "k1", "d", 3, {"v": "3"})]
    df = spark.createDataFrame(rows, "target string, row_key string, day_date string, seq int, rec map<string,string>")
    keyed.put_routed(spark, str(tmp_path), df, ["ta", "tb"], order=["seq"], batch_id=0)
    assert rows_of(keyed.KeyedTable(spark, f"{tmp_path}/ta", partition="day_date"), "row_key", "v") == [("k1", "3")]
    assert rows_of(keyed.KeyedTable(spark, f"{tmp_path}/tb", partition="day_date"), "row_key", "w") == [("k1", "2")]


def test_control_files_are_written_once(spark, tmp_path):
    files = ControlFiles(spark, str(tmp_path / "c"), "m")
    assert files.numbers() == []
    files.write(3, {"a": 1})
    with pytest.raises(FileExistsError):
        files.write(3, {"a": 2})
    assert files.read(3) == {"a": 1} and files.numbers() == [3]


def test_merge_statements():
    update, insert = jdbc.merge_statements("t", "s_t", ["name"], ["status", "at"])
    assert update == ("UPDATE t SET status = (SELECT s.status FROM s_t s WHERE s.name = t.name), "
                      "at = (SELECT s.at FROM s_t s WHERE s.name = t.name) "
                      "WHERE EXISTS (SELECT 1 FROM s_t s WHERE s.name = t.name)")
    assert insert == ("INSERT INTO t (name, status, at) SELECT s.name, s.status, s.at FROM s_t s "
                      "WHERE NOT EXISTS (SELECT 1 FROM t WHERE s.name = t.name)")


def test_merge_statements_run(spark):
    """The statements are plain SQL; an in-process engine shows what they do."""
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE t (name VARCHAR, status VARCHAR); INSERT INTO t VALUES ('a', 'old'), ('b', 'old')")
    con.execute("CREATE TABLE s_t (name VARCHAR, status VARCHAR); INSERT INTO s_t VALUES ('a', 'new'), ('c', 'new')")
    for _ in range(2):
        for sql in jdbc.merge_statements("t", "s_t", ["name"], ["status"]):
            con.execute(sql)
        assert con.execute("SELECT * FROM t ORDER BY name").fetchall() == [("a", "new"), ("b", "old"), ("c", "new")]


def test_target_hides_its_password():
    assert "secret" not in repr(jdbc.JdbcTarget("jdbc:x", "d", "u", "secret"))


def test_topic_files_and_fan_out(spark, tmp_path):
    df = spark.range(4)
    for _ in range(2):
        keyed.fan_out(df, [
            (F.col("id") < 1, lambda d: topics.write_topic_files(topics.as_json(d), str(tmp_path), "low", 5)),
            (None, lambda d: topics.write_topic_files(topics.as_json(d), str(tmp_path), "all", 5))])
    assert [r.value for r in spark.read.text(f"{tmp_path}/low").collect()] == ['{"id":0}']
    assert spark.read.text(f"{tmp_path}/all").count() == 4


def test_losing_writer_leaves_the_committed_row(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"))
    put(spark, table, [("a", "d", "1", "1", 1)], order=["seq"])
    stale = table.manifest()
    put(spark, table, [("b", "d", "2", "2", 2)], order=["seq"])
    other = keyed.KeyedTable(spark, str(tmp_path / "t"))
    other.manifest = lambda: stale
    with pytest.raises(FileExistsError):
        put(spark, other, [("c", "d", "3", "3", 3)], order=["seq"])
    assert rows_of(table, "row_key") == [("a",), ("b",)]
