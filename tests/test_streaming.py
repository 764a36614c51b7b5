"""Several micro-batches must give what one batch gives, and a replay the same again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiftlake.operators import brackets, counters, dedup, heartbeat, intervals, measurements, sequences
from shiftlake.operators.steps import STEPS
from shiftlake.sources.topics import stream_table
from shiftlake.streaming import builtin, carry, processors
from shiftlake.streaming.options import StreamOptions

BASE = dt.datetime(2024, 1, 1, 6, 0, 0)


def in_files(spark, df, folder, parts):
    """The rows in ``parts`` files, in time order."""
    rows = df.orderBy("ts", "seq").collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(str(folder))
    return stream_table(spark, str(folder), max_files=1)


@pytest.fixture(scope="module")
def steps(spark):
    rng, rows, at = random.Random(1), [], 0
    for seq in range(400):
        at += rng.randrange(1500)
        eqp = rng.choice(["Z2-DF01", "Z2-PE01", "Z2-PE01"])
        rows.append((eqp, "T", BASE + dt.timedelta(seconds=at), seq, eqp[:2], eqp[3:5], str(seq), rng.choice(STEPS[:3])))
    return spark.createDataFrame(rows, "eqpid string, tubeid string, ts timestamp, seq bigint, site string, "
                                       "eqp_type string, runcount string, step string")


def run_carry(spark, stream, step, root, delay=120, **more):
    sink = carry.parquet_sink(f"{root}/out")
    carry.run_ordered(stream, step, sink, f"{root}/carry", StreamOptions(f"{root}/checkpoint"), delay, **more).start().awaitTermination()
    carry.flush(spark, step, sink, f"{root}/carry")
    return spark.read.parquet(f"{root}/out")


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.mark.parametrize("by_shift", [False, True])
def test_intervals(spark, steps, tmp_path, by_shift):
    stream = in_files(spark, steps, tmp_path / "in", 4)
    step = carry.shift_interval_step() if by_shift else carry.step_interval_step()
    got = run_carry(spark, stream, step, tmp_path)
    mark = steps.agg(F.max("ts")).first()[0]
    want = intervals.step_intervals_by_shift(steps, open_until=F.lit(mark)) if by_shift else intervals.step_intervals(steps)
    columns = ["eqpid", "ts", "end_ts", "step", "step_name", "data_type", "ct", "runcount"] + ["orig_start"] * by_shift
    assert rows_of(got, *columns) == rows_of(want, *columns)
    again = carry.parquet_sink(f"{tmp_path}/out")
    carry.flush(spark, step, again, f"{tmp_path}/carry")
    assert rows_of(spark.read.parquet(f"{tmp_path}/out"), *columns) == rows_of(want, *columns)


class Now:
    """Runs the batch function directly, as a restart would."""

    def apply(self, df):
        return self

    def foreachBatch(self, fn):
        return fn


def test_late_and_future_rows_are_set_aside(spark, steps, tmp_path):
    folder = f"{tmp_path}/carry"
    each = carry.run_ordered(steps, carry.step_interval_step(), carry.parquet_sink(f"{tmp_path}/out"), folder, Now(), 0,
                             clock=lambda: (BASE + dt.timedelta(days=30)).replace(tzinfo=dt.timezone.utc).timestamp())
    rows = steps.where("seq between 100 and 150")
    each(rows.unionByName(steps.where("seq = 399").withColumn("ts", F.lit(BASE + dt.timedelta(days=400)))), 0)
    each(steps.where("seq < 10 or seq between 151 and 200"), 1)
    assert {r.seq for r in spark.read.parquet(f"{folder}/ahead").collect()} == {399}
    assert {r.seq for r in spark.read.parquet(f"{folder}/late").collect()} == set(range(10))
    assert spark.read.parquet(f"{tmp_path}/out").where("seq > 150").count() > 0


@pytest.mark.parametrize("parts", [1, 5])
def test_dedup_does_not_depend_on_batches(spark, steps, tmp_path, parts):
    got = run_carry(spark, in_files(spark, steps, tmp_path / "in", parts), carry.dedup_step(["eqpid"], 9000), tmp_path, delay=30)
    want = dedup.first_within_ttl(steps, ["eqpid"], 9000)
    assert want.count() > 20 and rows_of(got, "eqpid", "seq") == rows_of(want, "eqpid", "seq")


@pytest.fixture(scope="module")
def defects(spark):
    rng = random.Random(8)
    names = ["Ok", *measurements.DEFECTS[:3]]
    rows = [(f"B{rng.randrange(2)}", BASE + dt.timedelta(seconds=7 * k), k, rng.choice(names), rng.choice(names)) for k in range(400)]
    return spark.createDataFrame(rows, "boat_id string, ts timestamp, seq bigint, cell_q string, col_q string")


@pytest.mark.parametrize("parts,reverse", [(1, True), (4, False), (7, False)])
def test_defect_counters_do_not_depend_on_batches_or_order(spark, defects, tmp_path, parts, reverse):
    stream = in_files(spark, defects, tmp_path / "in", parts)
    if reverse:
        defects.orderBy(F.desc("ts")).coalesce(1).write.parquet(str(tmp_path / "turned"))
        stream = stream_table(spark, str(tmp_path / "turned"), max_files=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        got = run_carry(spark, stream, carry.defect_step(), tmp_path, delay=30)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = counters.defect_threshold(defects)
    columns = ["boat_id", "seq", "cell_q", "col_q", *[counters.counter_name(d) for d in measurements.DEFECTS]]
    assert rows_of(want, *columns) and rows_of(got, *columns) == rows_of(want, *columns)


def test_replayed_batch_gives_the_same(spark, steps, tmp_path):
    half = steps.where("seq < 200"), steps.where("seq >= 200")
    sink, folder = carry.parquet_sink(f"{tmp_path}/out"), f"{tmp_path}/carry"
    seen = []

    each = carry.run_ordered(steps, carry.step_interval_step(), sink, folder, Now(), 120)
    each(half[0], 0)
    for _ in range(2):
        each(half[1], 1)
        seen.append(rows_of(spark.read.parquet(f"{tmp_path}/out"), "eqpid", "ts", "end_ts"))
    assert seen[0] == seen[1] and len(seen[0]) > 100


def test_brackets(spark, tmp_path):
    rng, rows, at = random.Random(2), [], 0
    texts = ["recipe start recipe:", "recipe end recipe:", "other", "other"]
    for seq in range(300):
        at += rng.randrange(60)
        rows.append((rng.choice("ab"), "p", BASE + dt.timedelta(seconds=at), seq, f"{rng.choice(texts)} {seq}"))
    df = spark.createDataFrame(rows, "host string, path string, ts timestamp, seq bigint, line string")
    got = run_carry(spark, in_files(spark, df, tmp_path / "in", 3), carry.bracket_step(), tmp_path, delay=0)
    want = brackets.merge_brackets(df)
    assert rows_of(got, "host", "kind", "text") == rows_of(want, "host", "kind", "text")


def to_table(stream, root, **options):
    (StreamOptions(f"{root}/checkpoint", **options).apply(stream).outputMode("append").format("parquet")
     .option("path", f"{root}/out").start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def test_sequences_over_batches(spark, tmp_path):
    rng, rows, at = random.Random(4), [], 0
    for seq in range(120):
        at += rng.randrange(40)
        rows.append((rng.choice("xy"), BASE + dt.timedelta(seconds=at), seq, rng.choice(["order", "pay", "look"])))
    df = spark.createDataFrame(rows, "u string, ts timestamp, seq bigint, b string")
    pattern = sequences.Pattern(("a", "b"), ("b = 'order'", "b = 'pay'"), 60)
    stream = in_files(spark, df, tmp_path / "in", 2)
    got = to_table(processors.find_sequences(stream, pattern, "u", "0 seconds"), tmp_path)
    last = max(r[1] for r in rows)
    want = sequences.match_sequences(df, pattern, ["u"], flush_open=True)
    want = {(r.seq, r.outcome) for r in want.collect() if not (r.matched == 1 and (last - r.ts).total_seconds() < 60)
            or r.outcome == "match"}
    found = {(r.seq, r.outcome) for r in got.collect()}
    # A start whose span reaches past the last row is still open.
    open_ones = {r[2] for r in rows if (last - r[1]).total_seconds() < 60}
    assert {w for w in want if w[0] not in open_ones} == {f for f in found if f[0] not in open_ones}


def test_window_alarm_with_expected_devices(spark, tmp_path):
    beats = spark.createDataFrame([("Z2-H1", BASE + dt.timedelta(minutes=m), 0, 1) for m in (5, 200)],
                                  "eqp_id string, ts timestamp, seq bigint, ok int")
    expected = spark.createDataFrame([(e, BASE + dt.timedelta(hours=h), 0, 0) for e in ("Z2-H1", "Z2-H2") for h in range(4)],
                                     "eqp_id string, ts timestamp, seq bigint, ok int")
    streams = [in_files(spark, d, tmp_path / n, 1) for d, n in ((beats, "b"), (expected, "e"))]
    out = heartbeat.alarms(to_table(builtin.window_alarms(*streams, 3600), tmp_path))
    got = {(r.eqp_id, r.begin_time[11:13], r.status, r.cnt) for r in out.collect()}
    assert got == {("Z2-H1", "06", 1, 1), ("Z2-H1", "07", 0, 0), ("Z2-H1", "08", 0, 0),
                   ("Z2-H2", "06", 0, 0), ("Z2-H2", "07", 0, 0), ("Z2-H2", "08", 0, 0)}


def test_prod_needs_a_checkpoint():
    with pytest.raises(ValueError):
        StreamOptions(None, run_mode="prod")


def test_routes(spark):
    out = builtin.route(spark.range(4), {"low": F.col("id") < 1, "high": F.col("id") >= 1})
    assert {n: d.count() for n, d in out.items()} == {"low": 1, "high": 3}


def test_job_to_keyed_table_over_batches(spark, tmp_path):
    import json

    from shiftlake.functions.records import field
    from shiftlake.plans import jobs
    from shiftlake.sinks.keyed import KeyedTable, columns_of_map
    from shiftlake.streaming.runner import run_job

    def doc(state, **more):
        return json.dumps({"EqpID": "Z2-DF02", "PutTime": "2020-07-29 14:09:23", "State": state, **more})

    lines = spark.createDataFrame([(doc("PRD", RunCount="7"), BASE, 0), (doc(None, Note="n"), BASE, 1)],
                                  "value string, ts timestamp, seq bigint")
    stream = in_files(spark, lines, tmp_path / "in", 2).drop("ts")
    table = KeyedTable(spark, str(tmp_path / "table"), partition="day_date")
    seen = []

    def job(batch):
        rows = jobs.load_records(batch).withColumn("row_key", field("row_key"))
        return {"table": columns_of_map(rows), "count": rows}

    run_job(stream, job, {"table": lambda d, n: table.put(d, ["ts", "seq"], n), "count": lambda d, n: seen.append(d.count())},
            StreamOptions(str(tmp_path / "checkpoint"))).start().awaitTermination()
    assert sum(seen) == 2 and len(table.manifest()["parts"]) == 1
    assert [tuple(r) for r in table.read(["state", "runcount", "note"]).collect()] == [("PRD", "7", "n")]
