"""Defect counters per boat: threshold alarms and windowed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .measurements import DEFECTS
from .slices import SLICE, SLICE_SECONDS, slice_totals, with_slice

THRESHOLD = 10


def counter_name(defect: str) -> str:
    return "n_" + defect.replace(" ", "_")


# Column of a row that carries the counts of a key from before, one per category.
CARRIED = "_carried"


def _hits(defect: str) -> Column:
    """0, 1 or 2: a record counts for its cell class and for its colour class."""
    return ((F.lower("cell_q") == defect).cast("long") + (F.lower("col_q") == defect).cast("long"))


def _counted(df: DataFrame) -> dict[str, Column]:
    """Counter name -> what a row adds to it; a carrying row adds what it carries."""
    def adds(i: int, defect: str) -> Column:
        if CARRIED not in df.columns:
            return _hits(defect)
        return F.coalesce(F.col(CARRIED)[i], _hits(defect))

    return {counter_name(d): adds(i, d) for i, d in enumerate(DEFECTS)}


def carried_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One carrying row per key, at its last record, in the columns of ``df`` (which has ``CARRIED``)."""
    counts = _counted(df)
    rows = df.groupBy(*keys).agg(F.max(F.struct("ts", "seq")).alias("_last"), *[F.sum(c).alias(n) for n, c in counts.items()])
    rows = rows.select(*keys, F.col("_last.ts").alias("ts"), F.col("_last.seq").alias("seq"), F.array(*counts).alias(CARRIED))
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])


def defect_threshold(df: DataFrame, keys: Sequence[str] = ("boat_id",), threshold: int = THRESHOLD,
                     slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Records at which a running counter of the key reaches the threshold, with all counters.

    Rows need ``ts``, ``seq``, ``cell_q`` and ``col_q``. Rows with ``CARRIED``
    start a key at the counts they carry and are not returned. Counting per slice
    comes first; only the slices in which a counter crosses the threshold (at
    most one per key and category) are then ordered row by row.
    """
    names = [counter_name(d) for d in DEFECTS]
    rows = with_slice(df, "ts", slice_seconds)
    adds = _counted(df)
    totals = slice_totals(rows, keys, adds)
    crossed = F.lit(False)
    for n in names:
        crossed = crossed | ((F.col(f"{n}_before") < threshold)
                             & (F.col(f"{n}_before") + F.col(n) >= threshold))
    crossing = totals.where(crossed).select(*keys, SLICE, *[f"{n}_before" for n in names])

    running = Window.partitionBy(*keys, SLICE).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.join(crossing, [*keys, SLICE]).select(
        *df.columns,
        *[(F.col(f"{n}_before") + F.sum(adds[n]).over(running)).alias(n) for n in names])
    # A double hit may step over the threshold; either step landing on it counts.
    fired = F.lit(False)
    for n in names:
        fired = fired | ((F.col(n) >= threshold) & (F.col(n) - adds[n] < threshold))
    return counted.where(fired if CARRIED not in df.columns else fired & F.col(CARRIED).isNull())


def defect_window_counts(df: DataFrame, seconds: int = 60, keys: Sequence[str] = ("boat_id",)) -> DataFrame:
    """Counts of every category per key and tumbling window."""
    return df.groupBy(*keys, F.window("ts", f"{seconds} seconds").alias("w")).agg(
        *[F.sum(_hits(d)).alias(counter_name(d)) for d in DEFECTS]
    ).select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             *[counter_name(d) for d in DEFECTS])


def counter_adds() -> list[tuple[str, Column]]:
    """Name of every counter and what a record adds to it."""
    return [(counter_name(d), _hits(d)) for d in DEFECTS]
