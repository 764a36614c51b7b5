"""Wet-bench module states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, keys
from ..functions.records import field
from ..functions.text import is_date_time, is_equipment_id, parse_second, text_or_empty
from .enrich import enrichment


def module_states(df: DataFrame, record: str = "rec") -> DataFrame:
    """Records -> module rows with id, row key and enrichment; unknown modules are dropped."""
    rows = df.where(is_equipment_id(field("eqpid", record)) & is_date_time(field("puttime", record)))
    eqpid, put_time = field("eqpid", record), field("puttime", record)
    ts = parse_second(put_time)
    added = enrichment(eqpid, put_time, ts)
    name = text_or_empty(field("modulename", record))
    return rows.select(
        *[c for c in df.columns if c != record],
        keys.row_key(eqpid, put_time).alias("row_key"),
        eqpid.alias("eqpid"), put_time.alias("put_time"), ts.alias("ts"),
        name.alias("modulename"), codes.module_id(name).alias("module_id"),
        text_or_empty(field("e10state", record)).alias("e10state"),
        text_or_empty(field("statuscode", record)).alias("statuscode"),
        *[added[n].alias(n) for n in ("site", "factory", "day_date", "shift")],
    ).where("module_id is not null")
