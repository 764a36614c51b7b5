"""Change events of a database: unpacked per field, or applied to the latest state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import once

ENVELOPE = "struct<op:string,before:map<string,string>,after:map<string,string>>"


def parse_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope lines -> ``op, before, after``; lines without an operation are dropped."""
    rest = [c for c in df.columns if c != value]
    return once(df, _c=F.from_json(value, ENVELOPE)).select(*rest, "_c.*").where("op is not null")


def unpack_changes(df: DataFrame) -> DataFrame:
    """One row per field: ``change`` (CREATE, DELETE, UPDATE), ``side``, ``field``, ``field_value``.

    Snapshot reads count as creates. An update lists both sides.
    """
    def sides(*names: str) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("side"), F.col(n).alias("fields")) for n in names])

    change = (F.when(F.col("op").isin("r", "c"), F.lit("CREATE"))
              .when(F.col("op") == "d", F.lit("DELETE")).when(F.col("op") == "u", F.lit("UPDATE")))
    listed = (F.when(F.col("op").isin("r", "c"), sides("after"))
              .when(F.col("op") == "d", sides("before")).when(F.col("op") == "u", sides("before", "after")))
    rest = [c for c in df.columns if c not in ("op", "before", "after")]
    rows = df.select(*rest, change.alias("change"), F.explode(listed).alias("_s"))
    return rows.select(*rest, "change", F.col("_s.side").alias("side"),
                       F.explode("_s.fields").alias("field", "field_value"))


def latest_state(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Apply the changes: the last ``after`` of each key value, without deleted keys."""
    at = F.coalesce(F.try_element_at("after", F.lit(key)), F.try_element_at("before", F.lit(key)))
    last = df.select(at.alias("_key"), "op", "after", *order).groupBy("_key").agg(
        F.max_by(F.struct("op", "after"), F.struct(*order)).alias("_l"))
    return last.where("_l.op <> 'd'").select(F.col("_key").alias(key), F.col("_l.after").alias("after"))
