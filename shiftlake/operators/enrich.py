"""Standard enrichment of loader records, and the alarm-to-tube match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import codes, keys
from ..functions.records import field, once
from ..functions.text import is_equipment_id, not_blank, parse_second, strip, text_or_empty

TUBE_SLOTS = range(1, 6)
TUBE_DEVICE_TYPES = ("DF", "PE", "PR")


def valid_records(df: DataFrame, time_field: str = "puttime", record: str = "rec") -> DataFrame:
    """Keep records with a well-formed equipment id and a time that is not blank."""
    return df.where(is_equipment_id(field("eqpid", record)) & not_blank(field(time_field, record)))


def split_failed(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rows to put into quarantine."""
    good = F.coalesce(ok, F.lit(False))
    return df.where(good), df.where(~good)


def enrichment(eqpid: Column, put_time: Column, ts: Column, site: Column | None = None) -> dict[str, Column]:
    """The derived columns every loader adds, by name."""
    site = codes.site_of(eqpid) if site is None else site
    return {
        "site": site,
        "factory": codes.factory_id(site),
        "day_date": cal.day_date(ts),
        "shift": cal.shift_label(ts, site),
        "long_time": cal.epoch_seconds(ts).cast("string"),
    }


def enrich_records(df: DataFrame, time_field: str = "puttime", record: str = "rec",
                   suffix: Callable[[Column], Column] | None = None,
                   created: Column | None = None) -> DataFrame:
    """Add the derived entries to the map ``record``; entries already there stay.

    Also adds ``ts`` for partitioning and ordering. A time that is no real
    date leaves ``ts`` null: see ``split_failed``.
    """
    df = once(df, _eqp=field("eqpid", record), _time=field(time_field, record),
              ts=parse_second(field(time_field, record)))
    added = enrichment(F.col("_eqp"), F.col("_time"), F.col("ts"))
    added["row_key"] = keys.equipment_row_key(F.col("_eqp"), F.col("_time"),
                                              text_or_empty(field("tubeid", record)), suffix)
    if created is not None:
        added["create_time"] = created
    return add_entries(df, added, record).drop("_eqp", "_time")


def add_entries(df: DataFrame, entries: dict[str, Column], record: str = "rec") -> DataFrame:
    """Put ``entries`` into the map where the key is absent or null."""
    present = F.map_filter(record, lambda k, v: v.isNotNull())
    fresh = F.create_map(*[part for name, value in entries.items() for part in (F.lit(name), value)])
    missing = F.map_filter("_fresh", lambda k, v: ~F.map_contains_key(F.col("_present"), k))
    others = F.map_filter(record, lambda k, v: v.isNull() & ~k.isin(*entries))
    rows = once(df, _present=present, _fresh=fresh)
    return once(rows, **{record: F.map_concat("_present", others, missing)}).drop("_present", "_fresh")


def tube_of_status(eqpid: Column, status: Column, slots: list[Column]) -> Column:
    """``TubeID<n>`` of the first slot that names the alarm status, else empty.

    Only tube devices (DF, PE, PR) are looked at.
    """
    prefix = F.upper(F.substring(eqpid, 4, 2))
    match = F.when(F.lit(False), F.lit(None).cast("string"))
    for n, slot in enumerate(slots, 1):
        match = match.when(slot == status, F.lit(f"TubeID{n}"))
    return F.when(prefix.isin(*TUBE_DEVICE_TYPES) & not_blank(status), match.otherwise(F.lit(""))).otherwise(F.lit(""))


def match_alarm_tube(df: DataFrame, record: str = "rec",
                     suffix: Callable[[Column], Column] | None = None) -> DataFrame:
    """Enrich alarm records, add the matching ``tubeid`` and drop the five slots."""
    df = once(df, _eqp=strip(field("eqpid", record)), _time=strip(field("puttime", record)),
              ts=parse_second(field("puttime", record)))
    eqpid, put_time, ts = F.col("_eqp"), F.col("_time"), F.col("ts")
    tube = tube_of_status(eqpid, text_or_empty(field("status", record)),
                          [text_or_empty(field(f"tubeid{n}", record)) for n in TUBE_SLOTS])
    df = once(df, _tube=tube)
    entries = enrichment(eqpid, put_time, ts)
    entries["row_key"] = keys.equipment_row_key(eqpid, put_time, F.col("_tube"), suffix)
    entries["tubeid"] = F.col("_tube")
    out = add_entries(df, entries, record)
    dropped = [f"tubeid{n}" for n in TUBE_SLOTS]
    return out.withColumn(record, F.map_filter(record, lambda k, v: ~k.isin(*dropped))).drop("_tube", "_eqp", "_time")
