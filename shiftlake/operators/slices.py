"""Ordered per-key work that survives a key holding a third of all rows.

A window partitioned by the key alone puts a hot key into one task. Here the
rows of a key are cut into fixed time slices. Each (key, slice) is ordered on
its own, and only the few rows at the slice edges are then lined up per key.
A task of the first step holds what one key sends in one slice; the second
step holds at most a constant number of rows per slice, so it grows with the
covered time and not with the number of rows.

The slice is computed from the row itself, so a recomputed partition (a lost
executor, a speculative copy) always cuts at the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A quarter of an hour divides every shift boundary (07:30, 08:00, ...).
SLICE_SECONDS = 900
SLICE = "_slice"


def with_slice(df: DataFrame, ts: str, seconds: int = SLICE_SECONDS) -> DataFrame:
    return df.withColumn(SLICE, F.floor(F.unix_timestamp(F.col(ts)) / F.lit(seconds)).cast("long"))


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str],
                    name: str = "_next", ahead: int = 1, back: bool = False,
                    slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add ``name_1`` .. ``name_<ahead>``: columns ``take`` of the next rows of the key as structs.

    ``order`` starts with the event time and must be a total order within the
    key. With ``back`` the previous rows are taken instead. A missing
    neighbour is null.
    """
    step = F.lag if back else F.lead
    other = F.lead if back else F.lag
    offsets = range(1, ahead + 1)

    def neighbours(window) -> list[Column]:
        # Column by column: a struct made here would be shuffled beside the
        # columns it is made of.
        return [c for i in offsets for c in (
            step(F.lit(1), i).over(window).alias(f"_there_{i}"),
            *[step(t, i).over(window).alias(f"_n{i}_{t}") for t in take])]

    packed = [F.when(F.col(f"_there_{i}").isNotNull(),
                     F.struct(*[F.col(f"_n{i}_{t}").alias(t) for t in take])).alias(f"{name}_{i}") for i in offsets]

    local = Window.partitionBy(*keys, SLICE).orderBy(*order)
    rows = with_slice(df, order[0], slice_seconds)
    inner = rows.select("*", *neighbours(local)).where(F.col(f"_there_{ahead}").isNotNull())

    # The rows at the slice edges, read from the same exchange, move again.
    whole = Window.partitionBy(*keys).orderBy(*order)
    edges = rows.select(
        "*",
        step(F.lit(1), ahead).over(local).isNull().alias("_open"),
        other(F.lit(1), ahead).over(local).isNull().alias("_entry"),
    ).where("_open or _entry").select(*df.columns, "_open", *neighbours(whole)).where("_open")
    return inner.select(*df.columns, *packed).unionByName(edges.select(*df.columns, *packed))


def slice_totals(df: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Per (key, slice): ``<name>`` summed, and ``<name>_before`` over all earlier slices."""
    totals = df.groupBy(*keys, SLICE).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = (Window.partitionBy(*keys).orderBy(SLICE)
              .rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("*", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before")
                                for n in sums])
