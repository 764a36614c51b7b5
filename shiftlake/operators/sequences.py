"""Event sequences: a, then directly b (then c ...), within a time span per key.

The pattern is data: one row per step with a name and an SQL predicate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .slices import SLICE_SECONDS, with_neighbours


@dataclass(frozen=True)
class Pattern:
    """Predicates of the steps in order, and the span from the first to the last."""

    names: tuple[str, ...]
    predicates: tuple[str, ...]
    within_seconds: int


def load_pattern(spark: SparkSession, path: str, pattern_id: str, fmt: str = "json") -> Pattern:
    """Read the steps of one pattern: ``pattern_id, step_no, name, predicate, within_seconds``.

    Read it again for every batch, and a changed pattern takes effect with the next one.
    """
    rows = (spark.read.format(fmt).load(path).where(F.col("pattern_id") == pattern_id)
            .orderBy("step_no").select("name", "predicate", "within_seconds").collect())
    if len(rows) < 2:
        raise ValueError(f"pattern {pattern_id!r} needs at least two steps")
    return Pattern(tuple(r.name for r in rows), tuple(r.predicate for r in rows), int(rows[0].within_seconds))


def match_sequences(df: DataFrame, pattern: Pattern, keys: Sequence[str], flush_open: bool = False,
                    slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every first step with what became of it.

    Adds ``outcome``: ``match`` (all steps directly one after the other, the
    last less than the span after the first) or ``timeout`` (the next expected
    event came too late), ``matched`` (number of steps matched) and ``events``
    (the matched rows as structs). A different event in time drops the start
    silently. A start without a successor is open; ``flush_open`` reports it
    as a timeout.
    """
    steps = len(pattern.predicates)
    # Decide each step once per row, so that neighbours carry plain flags.
    flags = [f"_p{i}" for i in range(steps)]
    marked = df.select("*", *[F.coalesce(F.expr(p), F.lit(False)).alias(f)
                              for f, p in zip(flags, pattern.predicates)])
    rows = with_neighbours(marked, keys, ["ts", "seq"], [*df.columns, *flags[1:]], ahead=steps - 1,
                           slice_seconds=slice_seconds).where(F.col(flags[0]))

    span = pattern.within_seconds * 1_000_000
    matched, outcome = F.lit(steps), F.lit("match")
    for i in range(steps - 1, 0, -1):
        nxt = F.col(f"_next_{i}")
        late = F.unix_micros(nxt["ts"]) - F.unix_micros("ts") >= span
        missing = F.lit("timeout") if flush_open else F.lit(None).cast("string")
        outcome = (F.when(nxt.isNull(), missing).when(late, F.lit("timeout"))
                   .when(nxt[flags[i]], outcome))
        matched = F.when(nxt.isNull() | late, F.lit(i)).otherwise(matched)
    here = F.struct(*df.columns)
    chain = F.array(here, *[F.struct(*[F.col(f"_next_{i}")[c].alias(c) for c in df.columns])
                            for i in range(1, steps)])
    out = rows.select(*df.columns, outcome.alias("outcome"), matched.alias("matched"), chain.alias("events"))
    return out.where("outcome is not null").withColumn("events", F.slice("events", F.lit(1), F.col("matched")))


@dataclass(frozen=True)
class PatternVersion:
    """A pattern as it holds from ``valid_from`` (epoch seconds; None: always) until its next version."""

    pattern_id: str
    version: int
    valid_from: int | None
    pattern: Pattern


def pattern_versions(steps: DataFrame) -> list[PatternVersion]:
    """Patterns of a table ``pattern_id, version, valid_from, step_no, name, predicate, within_seconds`` (a row per step)."""
    found: dict[tuple[str, int], list] = {}
    for r in steps.orderBy("pattern_id", "version", "step_no").collect():
        found.setdefault((r.pattern_id, r.version), []).append(r)
    out = []
    for (pattern_id, version), rows in found.items():
        if len(rows) < 2:
            raise ValueError(f"pattern {pattern_id!r} version {version} needs at least two steps")
        at = rows[0].valid_from
        out.append(PatternVersion(pattern_id, version, None if at is None else int(at.timestamp()), Pattern(
            tuple(r["name"] for r in rows), tuple(r.predicate for r in rows), int(rows[0].within_seconds))))
    return out


# Predicates of a word of the bitset.
BITS = 62


def _bitset(predicates: Sequence[str]) -> Column:
    """Which predicates a row fulfils, as an array of words."""
    words = []
    for first in range(0, len(predicates), BITS):
        hits = [F.coalesce(F.expr(p), F.lit(False)).cast("long") * (1 << i) for i, p in enumerate(predicates[first:first + BITS])]
        word = hits[0]
        for h in hits[1:]:
            word = word + h
        words.append(word)
    return F.array(*words)


def _has(bits: Column, number: Column) -> Column:
    word = F.get(bits, F.floor(number / BITS).cast("int"))
    return F.call_function("getbit", word, (number % BITS).cast("int")) == 1


def match_patterns(df: DataFrame, versions: Sequence[PatternVersion], keys: Sequence[str], flush_open: bool = False,
                   slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """All patterns in one pass: ``keys, seq, ts`` of every first step, ``pattern_id, version, outcome, matched, last_seq``.

    A row decides each distinct predicate once and carries the answers as a
    bitset; the rows of a key are lined up once, whatever the number of
    patterns. The version of a pattern is the one valid at the first step.
    Outcomes are those of ``match_sequences``. The patterns are data in the
    plan, not code: their number does not grow the projection.
    """
    predicates = list(dict.fromkeys(p for v in versions for p in v.pattern.predicates))
    number = {p: i for i, p in enumerate(predicates)}
    rows = []
    for v in versions:
        # Until the next version of the same pattern starts.
        later = [o.valid_from for o in versions if o.pattern_id == v.pattern_id and o.valid_from is not None
                 and (v.valid_from is None or o.valid_from > v.valid_from)]
        rows.append((v.pattern_id, v.version, v.valid_from, min(later, default=None), [number[p] for p in v.pattern.predicates],
                     v.pattern.within_seconds * 1_000_000))
    constants = [F.struct(F.lit(i).alias("pattern_id"), F.lit(n).alias("version"), F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("stop"),
                          F.array(*map(F.lit, steps)).alias("steps"), F.lit(span).cast("long").alias("span")) for i, n, a, b, steps, span in rows]
    ahead = max(len(v.pattern.predicates) for v in versions) - 1
    marked = df.select(*keys, "ts", "seq", _bitset(predicates).alias("bits"))
    lined = with_neighbours(marked, keys, ["ts", "seq"], ["ts", "seq", "bits"], ahead=ahead, slice_seconds=slice_seconds)
    at = F.unix_timestamp("ts")
    begun = F.filter(F.array(*constants), lambda p: _has(F.col("bits"), p["steps"][0])
                     & (p["start"].isNull() | (p["start"] <= at)) & (p["stop"].isNull() | (p["stop"] > at)))
    starts = lined.select(*keys, "ts", "seq", F.array(*[F.col(f"_next_{i}") for i in range(1, ahead + 1)]).alias("next"), F.explode(begun).alias("p"))
    missing = F.lit("timeout" if flush_open else None).cast("string")

    def walk(state: Column, i: Column) -> Column:
        after = F.get("next", i - 1)
        late = F.unix_micros(after["ts"]) - F.unix_micros("ts") >= F.col("p.span")
        hit = _has(after["bits"], F.get("p.steps", i))
        ended = F.when(after.isNull(), F.struct(F.lit(False).alias("on"), missing.alias("outcome"), i.alias("matched"))).when(
            late, F.struct(F.lit(False).alias("on"), F.lit("timeout").alias("outcome"), i.alias("matched"))).when(
            hit, F.struct(F.lit(True).alias("on"), F.lit("match").alias("outcome"), (i + 1).alias("matched"))).otherwise(
            F.struct(F.lit(False).alias("on"), F.lit(None).cast("string").alias("outcome"), i.alias("matched")))
        return F.when(state["on"], ended).otherwise(state)

    begin = F.struct(F.lit(True).alias("on"), F.lit(None).cast("string").alias("outcome"), F.lit(1).alias("matched"))
    out = starts.withColumn("_o", F.aggregate(F.sequence(F.lit(1), F.size("p.steps") - 1), begin, walk)).where("_o.outcome is not null")
    last = F.when(F.col("_o.matched") > 1, F.get("next", F.col("_o.matched") - 2)["seq"]).otherwise(F.col("seq"))
    return out.select(*keys, "seq", "ts", "p.pattern_id", "p.version", "_o.outcome", "_o.matched", last.alias("last_seq"))
