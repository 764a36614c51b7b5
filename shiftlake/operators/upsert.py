"""Put semantics on DataFrames: a null does not erase, a delete removes the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_values(df: DataFrame, key: Sequence[str], order: Sequence[str],
                columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key; each column holds its latest non-null value."""
    columns = [c for c in df.columns if c not in {*key, *order}] if columns is None else columns
    rank = F.struct(*order)
    return df.groupBy(*key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])


def merge_rows(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Put ``new`` (one row per key) into ``old``. Columns only one side has are kept."""
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    a, b = old.alias("a"), new.alias("b")

    def side(frame: DataFrame, name: str, column: str) -> Column | None:
        return F.col(f"{name}.`{column}`") if column in frame.columns else None

    picked = []
    for c in columns:
        sides = [s for s in (side(new, "b", c), side(old, "a", c)) if s is not None]
        picked.append(F.coalesce(*sides).alias(c))
    on = [F.col(f"a.`{k}`") == F.col(f"b.`{k}`") for k in key]
    return a.join(b, on, "full_outer").select(*picked)


def without_keys(df: DataFrame, deleted: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(deleted.select(*key), list(key), "left_anti")


def routed(df: DataFrame, tables: dict[str, str], families: dict[str, str] | None = None,
           topic: str = "topic", key: str = "row_key") -> DataFrame:
    """Add ``target`` and ``family`` by topic; rows without topic, table or key are dropped."""
    families = families or {}
    target = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, table in tables.items():
        if table.strip():
            target = target.when(F.col(topic) == name, F.lit(table))
    family = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, value in families.items():
        family = family.when(F.col(topic) == name, F.lit(value))
    family = family.otherwise(F.lit(families.get("default", "cf")))
    blank = F.coalesce(F.length(F.trim(key)) == 0, F.lit(True))
    return df.select("*", target.alias("target"), family.alias("family")).where(
        F.col("target").isNotNull() & ~blank)
