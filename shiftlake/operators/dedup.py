"""First record per key, for good or until a time to live runs out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spacing import spaced_starts


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Earliest record of each key. Aggregated before the shuffle, so a hot key is harmless."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def first_within_ttl(df: DataFrame, keys: Sequence[str], ttl_seconds: int = 7200,
                     order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """First record per key, and again the first one once the kept record is
    ``ttl_seconds`` old. The time runs from the kept record, not the last one seen."""
    earliest = first_per_key(df.withColumn("_sec", F.unix_timestamp(order[0])), [*keys, "_sec"], order)
    starts = spaced_starts(earliest.select(*keys, "_sec"), keys, "_sec", ttl_seconds)
    return earliest.join(starts, [*keys, "_sec"], "left_semi").select(*df.columns)
