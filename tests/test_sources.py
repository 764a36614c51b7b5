import pytest
from pyspark.sql import functions as F

from shiftlake.plans.sqlscript import Statement, run_script
from shiftlake.sinks.jdbc import JdbcTarget
from shiftlake.sources import tables, topics

BENCH_COLUMNS = ["EqpID", "ModuleName", "E10State", "StatusCode", "ProcessStatus", "PutTime"]


def test_topic_options():
    one = topics.TopicSource("h:1", "a,b", start="Earliest", group="g", discovery_seconds=30, extra={"x.y": "1"})
    assert one.options() == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest",
                             "kafka.group.id": "g", "kafka.metadata.max.age.ms": "30000", "kafka.x.y": "1"}
    assert "startingOffsets" not in topics.TopicSource("h:1", "t", start="groupOffsets").options()
    assert topics.TopicSource("h:1", "t.*", is_pattern=True).options()["subscribePattern"] == "t.*"
    with pytest.raises(ValueError):
        topics.TopicSource("h:1", "t", start="sometime").options()


def test_tagging_and_charset(spark):
    raw = spark.createDataFrame([("t", bytearray("k", "utf-8"), bytearray("电池", "gbk"), 4)],
                                "topic string, key binary, value binary, seq bigint")
    assert tuple(topics.tag_records(raw, "topic", "GBK").first()) == ("t", "电池", 4)
    assert topics.tag_records(raw, "key", "GBK").first().topic == "k"
    with pytest.raises(ValueError):
        topics.tag_records(raw, "offset")


def test_csv_table_and_script(spark, tmp_path):
    path = tmp_path / "bench.csv"
    path.write_text('"Z2-BT01","SDR","PRD","1","x, y","2020-01-01 00:00:00"\n')
    direct = tables.csv_table(spark, str(path), BENCH_COLUMNS)
    assert direct.first().ProcessStatus == "x, y"
    out = run_script(spark, [
        Statement("SELECT EqpID, ProcessStatus FROM bench_csv WHERE E10State = 'PRD'", 2),
        Statement(tables.csv_view_ddl("bench_csv", str(path), BENCH_COLUMNS), 1),
    ], {"spark.sql.shuffle.partitions": 4})
    assert [tuple(r) for r in out[-1].collect()] == [("Z2-BT01", "x, y")]


def test_equal_orders_keep_their_place(spark):
    out = run_script(spark, [Statement("SELECT 1 AS a"), Statement("SELECT 2 AS a")])
    assert [d.first().a for d in out] == [1, 2]


def test_jdbc_view_statement():
    ddl = tables.jdbc_view_ddl("v", JdbcTarget("jdbc:x", "drv"), "t")
    assert ddl == "CREATE OR REPLACE TEMPORARY VIEW v USING jdbc OPTIONS (url 'jdbc:x', driver 'drv', dbtable 't')"


def test_dimension_is_kept_when_a_read_fails_or_is_empty(spark):
    now, answers = [0.0], []

    def load():
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return spark.createDataFrame([(v,) for v in answer], "v int")

    dim = tables.Refreshing(load, 10, lambda: now[0])
    answers[:] = [[1], RuntimeError("down"), [], [2]]
    seen = []
    for now[0] in (0, 5, 10, 20, 30):
        seen.append([r.v for r in dim.get().collect()])
    assert seen == [[1], [1], [1], [1], [2]]
    answers[:] = [RuntimeError("down")]
    with pytest.raises(RuntimeError):
        tables.Refreshing(load).get()


def test_json_view(spark):
    feed = spark.createDataFrame([('{"eqp_id":"e","cnt":"3","status":"0"}',)], ["value"])
    topics.json_view(spark, feed, "state_alarm", "eqp_id string, cnt string, status string")
    row = spark.sql("SELECT eqp_id, try_cast(cnt AS INT) AS cnt FROM state_alarm WHERE try_cast(status AS INT) = 0").first()
    assert tuple(row) == ("e", 3)


def test_source_options_keep_their_names():
    options = topics.TopicSource("b:9092", "t", extra={"maxOffsetsPerTrigger": "100", "failondataloss": "false", "fetch.max.bytes": "1",
                                                       "kafka.x": "y"}).options()
    assert options["maxOffsetsPerTrigger"] == "100" and options["failOnDataLoss"] == "false"
    assert options["kafka.fetch.max.bytes"] == "1" and options["kafka.x"] == "y"


def test_place_is_a_total_order(spark):
    rows = spark.createDataFrame([(p, o) for p in (0, 1, 2) for o in (0, 5, 1 << 40)], "partition int, offset bigint")
    got = [tuple(r) for r in rows.orderBy(topics.place("partition", "offset")).collect()]
    assert got == sorted(got) and rows.select(topics.place("partition", "offset")).distinct().count() == 9


def test_shared_folder_has_to_be_named(spark):
    from shiftlake.session import shared_dir

    class Bare:
        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        shared_dir(Bare)
    assert shared_dir(spark)


def test_dimension_is_tried_again_while_there_is_none(spark):
    from shiftlake.sources.tables import Refreshing

    tries = []

    def load():
        tries.append(1)
        if len(tries) == 1:
            raise OSError("not there yet")
        return spark.range(2)

    dim = Refreshing(load, clock=lambda: 5.0)
    with pytest.raises(RuntimeError):
        dim.get()
    assert dim.get().count() == 2


def test_view_statements_quote_their_options(spark, tmp_path):
    path = tmp_path / "it's"
    path.mkdir()
    (path / "a.csv").write_text("'x, y',\"z\n")
    spark.sql(tables.csv_view_ddl("odd_csv", str(path), ["a", "b"], "'"))
    assert [tuple(r) for r in spark.table("odd_csv").collect()] == [("x, y", '"z')]
