"""Intervals between state changes of a device, with and without shift cuts.

Input rows carry the key columns, ``ts``, ``seq`` (total order within equal
times), ``step``, ``eqp_type``, ``site`` and any payload columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.text import seconds_between
from .slices import SLICE, SLICE_SECONDS, with_neighbours, with_slice
from .steps import next_step

# Device type whose first record of a run stands for the run; for all other
# types it is the latest one.
FIRST_RECORD_TYPE = "DF"


def _runs_in_slices(df: DataFrame, keys: Sequence[str], payload: Sequence[str],
                    slice_seconds: int) -> DataFrame:
    """Collapse equal steps in a row, slice by slice: one row per run."""
    local = Window.partitionBy(*keys, SLICE).orderBy("ts", "seq")
    before = F.lag("step").over(local)
    rows = with_slice(df, "ts", slice_seconds).withColumn(
        "_start", (before.isNull() | (before != F.col("step"))).cast("int"))
    rows = rows.withColumn("_run", F.sum("_start").over(local.rowsBetween(Window.unboundedPreceding, 0)))

    # Latest time wins and, within one time, the smaller seq.
    late = F.when(F.col("eqp_type") == FIRST_RECORD_TYPE, -F.unix_micros("ts")).otherwise(F.unix_micros("ts"))
    rank = F.struct(late.alias("late"), (-F.col("seq")).alias("seq"))
    runs = rows.groupBy(*keys, SLICE, "_run").agg(
        F.first("step").alias("step"),
        F.first("eqp_type").alias("eqp_type"),
        F.min(F.struct("ts", "seq", "runcount")).alias("head"),
        F.max(rank).alias("rank"),
        F.max_by(F.struct(*payload), rank).alias("rep"),
    )
    ordered = Window.partitionBy(*keys, SLICE).orderBy("_run")
    follower = F.struct("head.ts", "head.seq", "head.runcount", "step")
    return runs.select(
        "*",
        F.lead(follower).over(ordered).alias("close"),
        F.lag(F.lit(1)).over(ordered).isNull().alias("_first"),
    )


def _edge_groups(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the runs that touch a slice edge so that continued ones share ``_grp``."""
    whole = Window.partitionBy(*keys).orderBy("head.ts", "head.seq")
    edges = runs.where(F.col("_first") | F.col("close").isNull())
    continued = (F.lag("step").over(whole) == F.col("step")) & (F.lag(SLICE).over(whole) != F.col(SLICE))
    edges = edges.withColumn("_new", (~F.coalesce(continued, F.lit(False))).cast("int"))
    return edges.withColumn("_grp", F.sum("_new").over(whole.rowsBetween(Window.unboundedPreceding, 0)))


def _closed_groups(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per continued run: whole-run representative and what closed it."""
    merged = edges.groupBy(*keys, "_grp").agg(
        F.first("step").alias("step"),
        F.first("eqp_type").alias("eqp_type"),
        F.min("head").alias("head"),
        F.max_by("rep", "rank").alias("rep"),
        F.max_by("close", "head").alias("close"),
    )
    after = Window.partitionBy(*keys).orderBy("_grp")
    follower = F.struct("head.ts", "head.seq", "head.runcount", "step")
    return merged.withColumn("close", F.coalesce("close", F.lead(follower).over(after)))


def _payload(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def step_intervals(df: DataFrame, keys: Sequence[str] = ("eqpid", "tubeid"),
                   slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Closed runs of equal steps: the representative row plus ``end_ts``,
    ``step_name`` (the step that followed), ``run_count_next``, ``data_type``
    (``Y`` when that is the successor in the cycle) and ``ct`` in seconds.

    The open last run of a key is not returned.
    """
    payload = _payload(df, keys)
    runs = _runs_in_slices(df, keys, payload, slice_seconds)
    kept = [*keys, "rep", "close"]
    inner = runs.where(~F.col("_first") & F.col("close").isNotNull()).select(*kept)
    merged = _closed_groups(_edge_groups(runs, keys), keys).where("close is not null").select(*kept)
    closed = inner.unionByName(merged)
    return closed.select(
        *keys, "rep.*",
        F.col("close.ts").alias("end_ts"),
        F.col("close.step").alias("step_name"),
        F.col("close.runcount").alias("run_count_next"),
    ).withColumn("data_type", _in_order(F.col("step"), F.col("step_name"))
    ).withColumn("ct", seconds_between(F.col("ts"), F.col("end_ts")))


def _in_order(step: Column, following: Column) -> Column:
    return F.when(next_step(step) == following, F.lit("Y")).otherwise(F.lit("N"))


def step_intervals_by_shift(df: DataFrame, keys: Sequence[str] = ("eqpid", "tubeid"),
                            slice_seconds: int = SLICE_SECONDS,
                            open_until: Column | None = None) -> DataFrame:
    """As ``step_intervals``, also cut at every shift switch inside a run.

    A piece that ends at a switch has the successor step as ``step_name`` and
    ``data_type`` Y. After a cut the run goes on from the switch; types other
    than DF then move to their latest record of the new shift. With
    ``open_until`` (a watermark) the pieces of the open last run that end at
    or before it are returned as well.
    """
    if 1800 % slice_seconds:
        raise ValueError("a slice must divide half an hour, so that no slice spans a shift switch")
    payload = _payload(df, keys)
    runs = _runs_in_slices(df, keys, payload, slice_seconds)
    kept = [*keys, "rep", "start_ts", "end_ts", "step_name", "data_type"]

    inner = runs.where(~F.col("_first") & F.col("close").isNotNull()).select(
        *keys, "rep", F.col("rep.ts").alias("start_ts"), F.col("close.ts").alias("end_ts"),
        F.col("close.step").alias("step_name"),
        _in_order(F.col("step"), F.col("close.step")).alias("data_type"))

    # Latest record per shift of a run, and what closed the run. All windows
    # keep to the key, so the edges are shuffled once.
    edges = _edge_groups(runs, keys).withColumn(
        "_shift", F.unix_timestamp(cal.shift_start(F.col("head.ts"), F.col("rep.site"))))
    per_shift = edges.groupBy(*keys, "_grp", "_shift").agg(
        F.first("eqp_type").alias("eqp_type"), F.first("step").alias("step"), F.min("head").alias("head"),
        F.max_by("rep", "rank").alias("rep"), F.max_by("close", "head").alias("close"))
    in_key = Window.partitionBy(*keys).orderBy("head.ts", "head.seq")
    follower = F.struct("head.ts", "head.seq", "head.runcount", "step")
    next_run = F.when(F.lead("_grp").over(in_key) != F.col("_grp"), F.lead(follower).over(in_key))
    per_shift = per_shift.withColumn("close", F.coalesce("close", next_run))
    in_run = Window.partitionBy(*keys, "_grp").orderBy("head.ts", "head.seq")
    per_shift = per_shift.select(
        *[c for c in per_shift.columns if c != "close"],
        F.last("close").over(in_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("close"),
        F.row_number().over(in_run).alias("_nth"), F.lead("_shift").over(in_run).alias("_later"))
    # A DF run stays with its first record, which then covers all shifts.
    stays = F.col("eqp_type") == FIRST_RECORD_TYPE
    per_shift = per_shift.where((F.col("_nth") == 1) | ~stays)
    next_shift = F.when(~stays, F.col("_later"))
    if open_until is None:
        per_shift = per_shift.where("close is not null")
    limit = F.coalesce(F.col("close.ts"), open_until) if open_until is not None else F.col("close.ts")
    per_shift = per_shift.withColumn("_limit", limit)

    half = cal.HALF_DAY
    last_shift = F.floor((F.unix_timestamp("_limit") - 1 - F.col("_shift")) / half) * half + F.col("_shift")
    until = F.greatest(F.coalesce(next_shift - half, last_shift), F.col("_shift"))
    # Sites without a shift calendar are never cut.
    uncut = F.array(F.lit(None).cast("long"))
    pieces = per_shift.select(
        *keys, "rep", "step", "close", "_limit", "_shift",
        F.explode(F.coalesce(F.sequence("_shift", until, F.lit(half).cast("long")), uncut)).alias("_at"))
    switch = F.timestamp_seconds(F.col("_at") + half)
    at_close = F.col("close").isNotNull() & F.coalesce(switch >= F.col("close.ts"), F.lit(True))
    pieces = pieces.select(
        *keys, "rep", "_limit",
        F.when(F.col("_at") > F.col("_shift"), F.timestamp_seconds("_at")).otherwise(F.col("rep.ts")).alias("start_ts"),
        F.when(at_close, F.col("close.ts")).otherwise(switch).alias("end_ts"),
        F.when(at_close, F.col("close.step")).otherwise(next_step(F.col("step"))).alias("step_name"),
        F.when(at_close, _in_order(F.col("step"), F.col("close.step"))).otherwise(F.lit("Y")).alias("data_type"),
    ).where(F.col("end_ts") <= F.col("_limit"))

    out = inner.unionByName(pieces.select(*kept))
    return out.select(
        *keys, F.col("rep.ts").alias("orig_start"),
        *[F.col("rep")[c].alias(c) for c in payload if c != "ts"],
        F.col("start_ts").alias("ts"), "end_ts", "step_name", "data_type",
        seconds_between(F.col("start_ts"), F.col("end_ts")).alias("ct"),
    )


def open_runs(df: DataFrame, keys: Sequence[str] = ("eqpid", "tubeid"), cut_until: Column | None = None,
              slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """The one row per key from which its open last run goes on later.

    With ``cut_until`` the run has been cut up to that moment, so it goes on
    from the last shift switch at or before it.
    """
    payload = _payload(df, keys)
    runs = _runs_in_slices(df, keys, payload, slice_seconds)
    rows = _closed_groups(_edge_groups(runs, keys), keys).where("close is null").select(*keys, "rep.*")
    if cut_until is not None:
        rows = rows.withColumn("ts", F.greatest("ts", cal.shift_start(cut_until, F.col("site"))))
    return rows.select(*df.columns)


def record_intervals(df: DataFrame, keys: Sequence[str] = ("eqpid", "modulename"),
                     terminal: Column | None = None,
                     slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every record closed by the next one of its key: ``end_ts`` and ``ct``.

    Rows where ``terminal`` holds keep an empty end and ct 0. The last record
    of a key is not returned.
    """
    paired = with_neighbours(df, keys, ["ts", "seq"], ["ts"],
                             slice_seconds=slice_seconds).where("_next_1 is not null")
    stays = F.lit(False) if terminal is None else terminal
    return paired.select(
        *df.columns,
        F.when(~stays, F.col("_next_1.ts")).alias("end_ts"),
        F.when(stays, F.lit(0).cast("long"))
        .otherwise(seconds_between(F.col("ts"), F.col("_next_1.ts"))).alias("ct"),
    )


def cycle_pairs(df: DataFrame, keys: Sequence[str] = ("eqpid", "tubeid"), emit_open: bool = False,
                slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Sliding pairs of records: each one with the time of the next as ``end_ts``.

    ``emit_open`` also returns the first record of each key on its own, with
    no end, as a count window does before it holds two records.
    """
    paired = with_neighbours(df, keys, ["ts", "seq"], ["ts"],
                             slice_seconds=slice_seconds)
    closed = paired.where("_next_1 is not null").select(*df.columns, F.col("_next_1.ts").alias("end_ts"))
    if not emit_open:
        return closed
    opening = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct("ts", "seq")).alias("r"))
    return closed.unionByName(opening.select("r.*", F.lit(None).cast("timestamp").alias("end_ts")))
