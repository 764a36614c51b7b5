"""State with a time to live, absence in a stream, applied changes, patterns and rules as data, commits, topics, scripts."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from shiftlake.functions.text import strip
from shiftlake.operators import heartbeat, sequences, steps
from shiftlake.plans.sqlscript import Setting, Statement, run_script
from shiftlake.sinks.changed import apply_changes, live_rows
from shiftlake.sinks.keyed import KeyedTable
from shiftlake.sources.tables import Refreshing
from shiftlake.sources.topics import json_view, read_topic_folders, stream_table
from shiftlake.streaming import carry, counting
from shiftlake.streaming.options import StreamOptions
from shiftlake.streaming.runner import CommittedSinks, run_fan_out

BASE = dt.datetime(2024, 1, 1, 6, 0, 0)


def in_files(spark, rows, schema, folder, parts):
    """The rows in ``parts`` files as they lie, a micro-batch each."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(str(folder))
    return stream_table(spark, str(folder), max_files=1)


# Counters with a time to live ------------------------------------------------------

COUNTED = "boat string, ts timestamp, seq bigint, a int, b int"


def adds():
    return [("n_a", F.col("a")), ("n_b", F.col("b"))]



def counted_rows():
    rng, rows, at = random.Random(9), [], 0
    for seq in range(300):
        at += rng.choice([20, 40, 70, 300, 2400])
        rows.append((rng.choice(["x", "x", "y"]), BASE + dt.timedelta(seconds=at), seq, rng.choice([0, 1, 2]), rng.choice([0, 0, 1])))
    # Neighbours within the delay change places.
    for i in range(0, 298, 3):
        if (rows[i + 1][1] - rows[i][1]).total_seconds() < 50:
            rows[i], rows[i + 1] = rows[i + 1], rows[i]
    return rows + [("end", BASE + dt.timedelta(days=30), 10_000, 0, 0)]


def brute_counters(rows, ttl, threshold):
    out, held = [], {}
    for boat, ts, seq, *hits in sorted(rows, key=lambda r: (r[1], r[2])):
        state = held.setdefault(boat, {})
        fired = False
        for i, hit in enumerate(hits):
            if i in state and (ts - state[i][1]).total_seconds() >= ttl:
                del state[i]
            if hit:
                n = state.get(i, (0,))[0]
                state[i] = (n + hit, ts)
                fired = fired or n < threshold <= n + hit
        if fired:
            out.append((boat, seq, state.get(0, (0,))[0], state.get(1, (0,))[0]))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 5])
def test_ttl_counters_do_not_depend_on_the_cut(spark, tmp_path, parts):
    rows = counted_rows()
    stream = in_files(spark, rows, COUNTED, tmp_path / "in", parts)
    found = counting.ttl_counters(stream, "boat", adds(), ["a"], 6, 3600).select("boat", "seq", "n_a", "n_b")
    StreamOptions(f"{tmp_path}/c").apply(found).format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination()
    got = sorted((r.boat, int(r.seq), r.n_a, r.n_b) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    want = brute_counters(rows, 3600, 6)
    assert len(want) > 10 and got == want


def test_ttl_counters_in_processing_time(spark, tmp_path):
    def run(seq, wait=0.0):
        time.sleep(wait)
        spark.createDataFrame([("x", BASE, seq, 1, 0)], COUNTED).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream_table(spark, f"{tmp_path}/in", COUNTED)
        found = counting.ttl_counters(stream, "boat", adds(), [], 2, ttl, counting.PROCESSING_TIME).select("boat", "seq", "n_a")
        StreamOptions(f"{tmp_path}/c", single_batch=True).apply(found).format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination()
        return sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/out").collect())

    ttl = 8
    assert run(1) == []
    # Counted on from the state of the first run.
    assert run(2) == [2]
    # Forgotten: the count starts again and passes the threshold once more.
    assert run(3, ttl + 1) == [2]
    assert run(4) == [2, 4]


# Silence ---------------------------------------------------------------------------

def beats_of(spark, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice(["Z2-CT01", "Z2-CT02", "T1-CT03"]), BASE + dt.timedelta(seconds=s * 37 + rng.randrange(30))) for s in range(400) if s % 90 < 50]
    return rows


@pytest.mark.parametrize("parts", [1, 4])
def test_silence_in_a_stream(spark, tmp_path, parts):
    rows = beats_of(spark)
    devices = spark.createDataFrame([("Z2-CT01",), ("Z2-CT02",), ("G1-CT09",)], "eqp_id string")
    read = []
    listed = Refreshing(lambda: read.append(1) or devices, max_age=0)
    stream = in_files(spark, rows, "eqp_id string, ts timestamp", tmp_path / "in", parts)
    step, sink = carry.silence_window_step(listed, 300), carry.parquet_sink(f"{tmp_path}/out")
    carry.run_ordered(stream, step, sink, f"{tmp_path}/carry", StreamOptions(f"{tmp_path}/c"), 60).start().awaitTermination()
    open_before = spark.read.parquet(f"{tmp_path}/out").count()
    carry.flush(spark, step, sink, f"{tmp_path}/carry")
    carry.flush(spark, step, sink, f"{tmp_path}/carry")
    got = spark.read.parquet(f"{tmp_path}/out").select("eqp_id", "w.start", "cnt", "status")
    want = heartbeat.silence_alarms(spark.createDataFrame(rows, "eqp_id string, ts timestamp"), devices, 300)
    assert sorted((r.eqp_id, str(r.start), r.cnt, r.status) for r in got.collect()) == sorted(
        (r.eqp_id, r.begin_time, r.cnt, r.status) for r in want.collect())
    assert got.where("status = 0").count() > 10 and open_before < got.count()
    assert len(read) >= parts


# Applied changes -------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_changes_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(f"k{rng.randrange(12)}", n, rng.choice("uuud"), str(n)) for n in range(80)]
    last = {k: (op, v) for k, n, op, v in sorted(rows, key=lambda r: r[1])}
    rng.shuffle(rows)
    table = KeyedTable(spark, f"{tmp_path}/t", key="id", partition="part")
    schema = "id string, seq int, op string, v string"
    batches = [spark.createDataFrame(rows[i:i + 20], schema).withColumn("part", F.crc32("id") % 3) for i in range(0, 80, 20)]
    applied = [apply_changes(table, batches[n], ["seq"], F.col("op") == "d", n) for n in (0, 1, 1, 2, 3, 2)]
    assert applied == [True, True, False, True, True, False]
    got = {r.id: r.v for r in live_rows(table, ["id", "v"]).collect()}
    assert got == {k: v for k, (op, v) in last.items() if op != "d"}


def test_late_upsert_does_not_revive(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", key="id")
    for n, row in enumerate([("a", 2, "u"), ("a", 9, "d"), ("a", 5, "u"), (None, 6, "u"), ("b", 1, "u")]):
        apply_changes(table, spark.createDataFrame([row], "id string, seq int, op string"), ["seq"], F.col("op") == "d", n)
    assert [r.id for r in live_rows(table, ["id"]).collect()] == ["b"]


# Many patterns ---------------------------------------------------------------------

def test_many_patterns_equal_each_alone(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(4), BASE + dt.timedelta(seconds=rng.randrange(40_000)), seq, rng.choice("abc"), rng.randrange(100)) for seq in range(400)]
    df = spark.createDataFrame(rows, "key int, ts timestamp, seq int, kind string, v int")
    half = int((BASE + dt.timedelta(seconds=20_000)).replace(tzinfo=dt.timezone.utc).timestamp())
    patterns = [sequences.Pattern(("x", "y"), (f"v < {20 + k}", f"v >= {k}"), 900) for k in range(40)]
    patterns += [sequences.Pattern(("x", "y", "z"), ("kind = 'a'", "kind <> 'c'", "kind = 'b'"), 3000)]
    versions = [sequences.PatternVersion(f"p{k}", 1, None, p) for k, p in enumerate(patterns)]
    versions.append(sequences.PatternVersion("p40", 2, half, sequences.Pattern(("x", "y"), ("kind = 'b'", "kind = 'c'"), 600)))
    for flush in (False, True):
        found = sequences.match_patterns(df, versions, ["key"], flush_open=flush)
        got = sorted((r.pattern_id, r.version, r.seq, r.outcome, r.matched, r.last_seq) for r in found.collect())
        want = []
        for v in versions:
            if v.pattern_id in ("p0", "p17", "p39", "p40"):
                alone = sequences.match_sequences(df, v.pattern, ["key"], flush_open=flush)
                for r in alone.collect():
                    at = int(r.ts.replace(tzinfo=dt.timezone.utc).timestamp())
                    if v.pattern_id != "p40" or (at >= half) == (v.version == 2):
                        want.append((v.pattern_id, v.version, r.seq, r.outcome, r.matched, r.events[-1].seq))
        assert [g for g in got if g[0] in ("p0", "p17", "p39", "p40")] == sorted(want)


def test_pattern_table_needs_two_steps(spark):
    rows = spark.sql("SELECT 'p' AS pattern_id, 1 AS version, CAST(NULL AS TIMESTAMP) AS valid_from, 1 AS step_no, 's' AS name, 'true' AS predicate, 5 AS within_seconds")
    with pytest.raises(ValueError, match="two steps"):
        sequences.pattern_versions(rows)


# Rules as a table --------------------------------------------------------------------

def test_rules_as_a_table(spark):
    rng = random.Random(5)
    texts = ["process started", "Process Started", "end of process", "xx end of process", "End of process", "recipe end", "8.0", "", None, "mid", "a mid end", "MID"]
    extra = tuple(steps.StepRule("DF", kind, text, f"S{k}") for k, (kind, text) in enumerate(
        [("contains", "mid"), ("exact", "a mid end"), ("contains", "end"), ("exact", "MID"), ("same", "mid")]))
    rules = steps.STEP_RULES + extra
    rows = [(k, rng.choice(["DF", "PE", "PR", "TA", "ZZ", None]), text) for k in range(6) for text in texts]
    df = spark.createDataFrame(rows, "k int, eqp_type string, _text string")
    table = spark.createDataFrame([(k, r.eqp_type, r.kind, r.text, r.step) for k, r in enumerate(rules)],
                                  "rule_no int, eqp_type string, kind string, text string, step string")
    want = df.select("*", steps.tag_step(F.col("eqp_type"), strip(F.col("_text")), rules).alias("step"))
    got = steps.tag_steps(df, table)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


# Several sinks, one commit ------------------------------------------------------------

def test_crash_between_two_sinks_is_repaired(spark, tmp_path):
    rows = [(BASE + dt.timedelta(seconds=k), k) for k in range(60)]
    stream = in_files(spark, rows, "ts timestamp, seq int", tmp_path / "in", 3)

    class Failing(CommittedSinks):
        broken = True

        def write(self, outputs, batch_id):
            if batch_id == 1 and Failing.broken:
                Failing.broken = False
                name, first = next(iter(outputs.items()))
                first.write.mode("overwrite").parquet(f"{self._root}/{name}/{batch_id}")
                raise RuntimeError("lost between two targets")
            return super().write(outputs, batch_id)

    sinks = Failing(spark, f"{tmp_path}/out")

    def start():
        job = lambda b: {"even": b.where("seq % 2 = 0"), "odd": b.where("seq % 2 = 1")}
        run_fan_out(stream, job, sinks, StreamOptions(f"{tmp_path}/c")).start().awaitTermination()

    with pytest.raises(Exception, match="lost between"):
        start()
    # What a reader sees of the broken batch is nothing, in either target.
    assert sinks.read("even").count() == 10 and sinks.read("odd").count() == 10
    start()
    assert sorted(r.seq for n in ("even", "odd") for r in sinks.read(n).collect()) == list(range(60))
    assert sinks.write({"even": sinks.read("odd")}, 1) is False


# Topics and views ----------------------------------------------------------------------

@pytest.mark.parametrize("topics, is_pattern, want", [("a1,b", False, {"a1", "b"}), (r"a\d", True, {"a1", "a2"})])
def test_topic_folders(spark, tmp_path, topics, is_pattern, want):
    def publish(topic, n):
        spark.createDataFrame([(n,)], "n int").write.mode("append").parquet(f"{tmp_path}/in/{topic}")

    def run():
        rows = read_topic_folders(spark, f"{tmp_path}/in", topics, "n int", is_pattern)
        StreamOptions(f"{tmp_path}/c").apply(rows).format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination()

    publish("a1", 1)
    publish("xa1", 9)
    run()
    for n, topic in enumerate(("a1", "a2", "b", "a11")):
        publish(topic, n + 2)
    run()
    got = [(r.topic, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == sorted((t, n) for t, n in [("a1", 1), ("a1", 2), ("a2", 3), ("b", 4)] if t in want)


def test_view_leaves_out_malformed_lines(spark):
    lines = ['{"a": "1"}', '{"a": 2, "b": 3}', "{broken", "[1]", "", None, "{}"]
    json_view(spark, spark.createDataFrame(list(enumerate(lines)), "seq int, value string"), "lines_view", "a STRING", ["seq"])
    assert [tuple(r) for r in spark.sql("SELECT seq, a FROM lines_view ORDER BY seq").collect()] == [(0, "1"), (1, "2"), (6, None)]


# Scripts ---------------------------------------------------------------------------------

def test_settings_by_type(spark, tmp_path):
    got = run_script(spark, [Statement("SELECT ${t.n} + 1 AS n, '${t.s}' AS s, ${t.b} AS b, ${t.d} AS d")], [
        Setting("t.n", "int", "4"), Setting("t.s", "string", "x"), Setting("t.b", "boolean", "True"), Setting("t.d", "double", "1.5")])[-1].first()
    assert (got.n, got.s, got.b, float(got.d)) == (5, "x", True, 1.5)
    for kind, value in (("int", "x"), ("boolean", "yes"), ("double", ""), ("date", "1")):
        with pytest.raises(ValueError):
            run_script(spark, [], [Setting("t.bad", kind, value)])
