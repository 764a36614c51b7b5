"""Ordered operators against plain loops, with a hot key, ties and narrow slices."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiftlake.operators import brackets, counters, dedup, intervals, sequences
from shiftlake.operators.measurements import DEFECTS
from shiftlake.operators.slices import with_neighbours
from shiftlake.operators.steps import STEPS

BASE = dt.datetime(2024, 1, 1, 6, 0, 0)
NEXT = dict(zip(STEPS, STEPS[1:] + STEPS[:1]))
SITES = {"DF": "G1", "PE": "Z2", "TA": "X1"}


def moments(rng, n, step):
    """Times in order, with ties and long gaps."""
    at, out = 0, []
    for _ in range(n):
        at += rng.choice([0, 0, 1, rng.randrange(step), rng.randrange(step) * (40 if rng.random() < 0.05 else 1)])
        out.append(BASE + dt.timedelta(seconds=at))
    return out


@pytest.fixture(scope="module")
def step_rows():
    rng = random.Random(5)
    rows, seq = [], 0
    for key, n in (("DF", 600), ("PE", 600), ("TA", 150), ("PE2", 40)):
        step = "LOAD"
        for at in moments(rng, n, 900):
            if rng.random() < 0.35:
                step = rng.choice(STEPS)
            seq += 1
            rows.append((f"Z-{key}", "T1", at, seq, SITES[key[:2]], key[:2], str(seq), step))
    return rows


def step_frame(spark, rows):
    return spark.createDataFrame(rows, "eqpid string, tubeid string, ts timestamp, seq bigint, site string, "
                                       "eqp_type string, runcount string, step string")


def offset(site):
    return {"G": 27000, "Z": 28800}.get(site[0])


def switch_after(ts, site):
    base = dt.datetime(2000, 1, 1) + dt.timedelta(seconds=offset(site))
    return base + ((ts - base) // dt.timedelta(hours=12) + 1) * dt.timedelta(hours=12)


def expected_intervals(rows, by_shift, until=None):
    out = []
    for key in sorted({r[0] for r in rows}):
        rep = None
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[3])):
            if rep is not None:
                rep = cut(rep, r[2], r[7] != rep["step"], by_shift, out)
            if rep is None or rep["step"] != r[7]:
                if rep is not None:
                    out.append((key, rep["at"], rep["count"], rep["step"], r[2], r[7], "Y" if NEXT[rep["step"]] == r[7] else "N"))
                rep = {"at": r[2], "count": r[6], "step": r[7], "site": r[4], "key": key, "type": r[5]}
            elif rep["type"] != "DF" and r[2] > rep["at"]:
                rep = {**rep, "at": r[2], "count": r[6]}
        if until is not None and rep is not None:
            cut(rep, until + dt.timedelta(seconds=1), False, by_shift, out)
    return sorted(out)


def cut(rep, now, closing, by_shift, out):
    """Shift switches passed before ``now``; a row at the switch belongs after it."""
    while by_shift and offset(rep["site"]) is not None:
        b = switch_after(rep["at"], rep["site"])
        if b > now or (closing and b == now):
            break
        out.append((rep["key"], rep["at"], rep["count"], rep["step"], b, NEXT[rep["step"]], "Y"))
        if b == now and rep["type"] != "DF":
            rep = {**rep, "at": b}
            break
        rep = {**rep, "at": b}
    return rep


COLUMNS = ["eqpid", "ts", "runcount", "step", "end_ts", "step_name", "data_type"]


@pytest.mark.parametrize("width", [60, 900])
def test_step_intervals(spark, step_rows, width):
    got = intervals.step_intervals(step_frame(spark, step_rows), slice_seconds=width)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == expected_intervals(step_rows, False)


@pytest.mark.parametrize("width", [60, 900])
def test_step_intervals_by_shift(spark, step_rows, width):
    got = intervals.step_intervals_by_shift(step_frame(spark, step_rows), slice_seconds=width)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == expected_intervals(step_rows, True)


def test_open_run_is_cut_up_to_the_mark(spark, step_rows):
    mark = max(r[2] for r in step_rows) + dt.timedelta(days=2)
    got = intervals.step_intervals_by_shift(step_frame(spark, step_rows), open_until=F.lit(mark))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == expected_intervals(step_rows, True, mark)


@pytest.mark.parametrize("width", [1, 60, 100_000])
@pytest.mark.parametrize("ahead", [1, 3])
def test_neighbours(spark, step_rows, width, ahead):
    df = step_frame(spark, step_rows).select("eqpid", "ts", "seq")
    for back in (False, True):
        got = with_neighbours(df, ["eqpid"], ["ts", "seq"], ["seq"], ahead=ahead, back=back, slice_seconds=width)
        found = {r.seq: [None if r[f"_next_{i}"] is None else r[f"_next_{i}"].seq for i in range(1, ahead + 1)]
                 for r in got.collect()}
        want = {}
        for key in {r[0] for r in step_rows}:
            seqs = [r[3] for r in sorted((r for r in step_rows if r[0] == key), key=lambda r: (r[2], r[3]))]
            for i, s in enumerate(seqs):
                at = [i - j if back else i + j for j in range(1, ahead + 1)]
                want[s] = [seqs[a] if 0 <= a < len(seqs) else None for a in at]
        assert found == want


def test_cycle_pairs_with_open_record(spark):
    rows = [("E", "T", BASE + dt.timedelta(minutes=m), m) for m in (0, 5, 9)]
    df = spark.createDataFrame(rows, "eqpid string, tubeid string, ts timestamp, seq bigint")
    got = {(r.seq, r.end_ts and r.end_ts.minute) for r in intervals.cycle_pairs(df, emit_open=True).collect()}
    assert got == {(0, 5), (5, 9), (0, None)}


def bracket_rows(rng, n, hosts, texts):
    rows, seq = [], 0
    for host in hosts:
        for at in moments(rng, n, 90):
            seq += 1
            rows.append((host, at, seq, f"{rng.choice(texts)} {seq}"))
    return rows


def expected_brackets(rows, timeout):
    out = []
    for host in {r[0] for r in rows}:
        begun = None
        for _, at, seq, line in sorted((r for r in rows if r[0] == host), key=lambda r: (r[1], r[2])):
            if begun and (at - begun[0]).total_seconds() > timeout:
                out.append((host, "miss_end", " ".join(begun[1])))
                begun = None
            low = line.lower()
            if "recipe start recipe:" in low:
                begun = begun or (at, [])
                begun[1].append(line)
            elif "recipe end recipe:" in low:
                if begun:
                    out.append((host, "merged", " ".join([*begun[1], line])))
                else:
                    out.append((host, "miss_begin", line))
                begun = None
            elif begun:
                begun[1].append(line)
        if begun:
            out.append((host, "miss_end", " ".join(begun[1])))
    return sorted(out)


@pytest.mark.parametrize("texts", [
    ["Recipe Start recipe: a", "recipe END recipe: a", "other", "other"],
    ["Recipe Start recipe: a"] * 5 + ["other", "recipe END recipe: a"],
    ["Recipe Start recipe: a", "other"],
])
def test_brackets(spark, texts):
    rows = bracket_rows(random.Random(len(texts)), 500, ["h1", "h2"], texts)
    df = spark.createDataFrame(rows, "host string, ts timestamp, seq bigint, line string")
    got = brackets.merge_brackets(df, ["host"]).select("host", "kind", "text")
    assert sorted(map(tuple, got.collect())) == expected_brackets(rows, 120)


def test_bracket_limits(spark):
    def at(s):
        return BASE + dt.timedelta(seconds=s)

    rows = [("a", at(0), 1, "recipe start recipe:"), ("a", at(120), 2, "recipe end recipe:"),
            ("b", at(0), 1, "recipe start recipe:"), ("b", at(121), 2, "recipe end recipe:")]
    df = spark.createDataFrame(rows, "host string, ts timestamp, seq bigint, line string")
    got = {(r.host, r.kind) for r in brackets.merge_brackets(df, ["host"]).collect()}
    assert got == {("a", "merged"), ("b", "miss_end"), ("b", "miss_begin")}


def test_first_within_ttl(spark):
    rng = random.Random(3)
    rows = [(k, at, i) for k in ("a", "b") for i, at in enumerate(moments(rng, 400, 600))]
    df = spark.createDataFrame(rows, "k string, ts timestamp, seq bigint")
    want = []
    for k in ("a", "b"):
        kept = None
        for _, at, seq in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:]):
            if kept is None or (at - kept).total_seconds() >= 1000:
                kept = at
                want.append((k, seq))
    got = dedup.first_within_ttl(df, ["k"], 1000).select("k", "seq")
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("width", [60, 900])
def test_defect_threshold(spark, width):
    rng = random.Random(9)
    names = [*DEFECTS, "FaHong", "none"]
    rows = [(f"b{rng.choice([0, 0, 0, 1])}", at, i, rng.choice(names), rng.choice(names))
            for i, at in enumerate(moments(rng, 300, 60))]
    df = spark.createDataFrame(rows, "boat_id string, ts timestamp, seq bigint, cell_q string, col_q string")
    counts, want = {}, []
    for boat, _, seq, cell, col in sorted(rows, key=lambda r: (r[1], r[2])):
        mine = counts.setdefault(boat, dict.fromkeys(DEFECTS, 0))
        fired = False
        for name in (cell.lower(), col.lower()):
            if name in mine:
                mine[name] += 1
                fired = fired or mine[name] == 10
        if fired:
            want.append((boat, seq, *[mine[d] for d in DEFECTS]))
    got = counters.defect_threshold(df, slice_seconds=width).select(
        "boat_id", "seq", *[counters.counter_name(d) for d in DEFECTS])
    assert sorted(map(tuple, got.collect())) == sorted(want)


ORDERS = [("1", "2222", "order", 0), ("1", "2222", "pay", 1), ("2", "2223", "pay", 2), ("2", "2224", "order", 3),
          ("2", "2224", "order", 7)]


def test_order_then_pay(spark):
    rows = [(u, o, b, BASE + dt.timedelta(seconds=s), i) for i, (u, o, b, s) in enumerate(ORDERS)]
    df = spark.createDataFrame(rows, "userid string, orderid string, behave string, ts timestamp, seq bigint")
    pattern = sequences.Pattern(("start", "next"), ("behave = 'order'", "behave = 'pay'"), 3)
    got = {(r.seq, r.outcome, r.events[-1].seq) for r in sequences.match_sequences(df, pattern, ["userid"]).collect()}
    assert got == {(0, "match", 1), (3, "timeout", 3)}
    flushed = sequences.match_sequences(df, pattern, ["userid"], flush_open=True)
    assert {(r.seq, r.outcome) for r in flushed.collect()} == {(0, "match"), (3, "timeout"), (4, "timeout")}


def test_pattern_as_data(spark, tmp_path):
    import json
    lines = [{"pattern_id": "p", "step_no": n, "name": name, "predicate": f"behave = '{name}'", "within_seconds": 3}
             for n, name in ((2, "pay"), (1, "order"))]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, lines)))
    assert sequences.load_pattern(spark, str(tmp_path / "p.json"), "p") == sequences.Pattern(
        ("order", "pay"), ("behave = 'order'", "behave = 'pay'"), 3)


def test_spacing_of_a_key_that_is_never_silent(spark):
    from shiftlake.operators.spacing import spaced_starts

    weeks = 3 * 7 * 86400
    every = spark.range(0, weeks, 1, 4).select(F.lit("hot").alias("k"), F.lit(None).cast("string").alias("n"), F.col("id").alias("sec"))
    got = sorted(r.sec for r in spaced_starts(every, ["k", "n"], "sec", 7200).collect())
    assert got == list(range(0, weeks, 7200))


def test_spacing_against_brute_force(spark):
    import random

    from shiftlake.operators.spacing import spaced_starts

    rng = random.Random(5)
    rows = sorted({(rng.choice("abc"), rng.randrange(400)) for _ in range(300)})
    resets = {r for r in rows if rng.random() < 0.05}
    df = spark.createDataFrame([(k, s, (k, s) in resets) for k, s in rows], "k string, sec bigint, again boolean")
    for strict in (False, True):
        want, last = [], {}
        for k, s in rows:
            reach = 21 if strict else 20
            if k not in last or (k, s) in resets or s - last[k] >= reach:
                want.append((k, s))
                last[k] = s
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
        try:
            got = sorted((r.k, r.sec) for r in spaced_starts(df, ["k"], "sec", 20, strict, F.col("again")).collect())
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want
