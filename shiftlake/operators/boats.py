"""Wide tube-boat snapshots turned into one row per boat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, keys
from ..functions.records import field
from ..functions.text import is_date_time, is_equipment_id, not_blank, strip, text_or_empty
from .enrich import enrichment

BOAT_SLOTS = 12
TUBE_COUNTERS = tuple(f"tube{n}.runcount" for n in range(1, 6))
PROCESSING = "Processing"
# Boat attribute in the record -> column.
BOAT_FIELDS = {
    "tube": "tube_id",
    "recipe": "recipe",
    "cooltime": "cool_time",
    "state": "state",
    "loadstate": "load_state",
    "position": "position",
    "loadmode": "load_mode",
    "cooltimedefined": "cool_time_defined",
    "boatid": "boat_id",
    "boatruns": "boat_runs",
}


def snapshot_records(df: DataFrame, record: str = "rec") -> DataFrame:
    return df.where(is_equipment_id(field("eqpid", record)) & is_date_time(field("puttime", record)))


def with_run_counts(df: DataFrame, record: str = "rec") -> DataFrame:
    """Snapshots in which all five run counts are filled."""
    filled = F.lit(True)
    for name in TUBE_COUNTERS:
        filled = filled & not_blank(field(name, record))
    return df.where(filled)


def unpivot_boats(df: DataFrame, processing_only: bool, record: str = "rec") -> DataFrame:
    """One row per boat whose tube belongs to the device.

    ``processing_only`` keeps boats in state Processing with a run count;
    otherwise boats with run count, boat id and any load state. The tube
    number names the column that holds the run count.
    """
    def text(name: Column) -> Column:
        return strip(text_or_empty(F.try_element_at(F.col(record), name)))

    eqpid = field("eqpid", record)
    rows = df.select(
        *[c for c in df.columns if c != record], record,
        eqpid.alias("eqp_id"), field("puttime", record).alias("put_time"),
        F.concat(F.element_at(F.split(eqpid, "-"), -1), F.lit("-")).alias("_own"))

    # BOAT_FIELDS maps the source name of a field to its column.
    def of_slot(slot: Column, source: str) -> Column:
        return text(F.concat(F.lit("boat"), slot, F.lit("." + source)))

    # Only the slots with an own tube become rows, and only their fields go along. The tubes of all slots are
    # looked up by constant names, in generated code; the other fields only for the slots that stay.
    tubes = F.array(*[F.struct(F.lit(str(n)).alias("slot"), text(F.lit(f"boat{n}.tube")).alias("tube"))
                      for n in range(1, BOAT_SLOTS + 1)])
    own = F.filter(tubes, lambda e: F.startswith(e["tube"], F.col("_own")))
    found = F.transform(own, lambda e: F.struct(*[
        (e["tube"] if s == "tube" else of_slot(e["slot"], s)).alias(c) for s, c in BOAT_FIELDS.items()]))
    boats = rows.select("*", F.inline(found))
    number = F.replace(F.col("tube_id"), F.col("_own"), F.lit(""))
    boats = boats.withColumn("run_count", text(F.concat(F.lit("tube"), number, F.lit(".runcount"))))
    boats = boats.where(not_blank(F.col("run_count")))
    if processing_only:
        boats = boats.where(F.col("load_state") == PROCESSING)
    else:
        boats = boats.where(not_blank(F.col("boat_id")) & not_blank(F.col("load_state")))
    return boats.drop("_own", record)


def boat_key(processing_only: bool) -> Column:
    if processing_only:
        return keys.row_key(F.col("eqp_id"), F.col("tube_id"), F.col("boat_id"), F.col("run_count"))
    return keys.row_key(F.col("tube_id"), F.col("boat_id"), F.col("run_count"),
                        codes.load_state_code(F.col("load_state")), F.col("put_time"))


def enrich_boats(df: DataFrame, processing_only: bool, ts: Column) -> DataFrame:
    added = enrichment(F.col("eqp_id"), F.col("put_time"), ts)
    added.pop("long_time")
    return df.select("*", *[c.alias(n) for n, c in added.items()], boat_key(processing_only).alias("row_key"))
