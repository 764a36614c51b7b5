"""Equipment status and alarm records split into history, action and update rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.records import field, has_keys
from ..functions.text import contains_ignoring_case, is_equipment_id, not_blank, parse_mixed, text_or_empty

CLEARED = "cleared"


def status_records(df: DataFrame) -> DataFrame:
    """Status changes with all four fields and a well-formed id."""
    return df.where(has_keys(["newstatus", "oldstatus", "newtime", "oldtime"]) & is_equipment_id(field("eqpid")))


def status_history(df: DataFrame) -> DataFrame:
    """One history row per status change; each date parsed by its own format."""
    return df.select(
        field("eqpid").alias("name"),
        text_or_empty(field("newstatus")).alias("statuscodename"),
        text_or_empty(field("newstatus")).alias("newstatusname"),
        text_or_empty(field("oldstatus")).alias("oldstatusname"),
        parse_mixed(field("newtime")).alias("laststatusdate"),
        parse_mixed(field("oldtime")).alias("oldstatusdate"),
        F.lit(None).cast("string").alias("usetime"),
        text_or_empty(field("tubeid")).alias("tubeid"),
    )


def status_update(df: DataFrame, status: str = "newstatus", time: str = "newtime",
                  order: tuple[str, ...] = ()) -> DataFrame:
    """The row that keeps the latest status of a device."""
    return df.select(
        field("eqpid").alias("name"),
        text_or_empty(field(status)).alias("statuscodename"),
        parse_mixed(field(time)).alias("laststatusdate"),
        F.lit("false").alias("prdtimeflag"),
        *order,
    )


def alarm_records(df: DataFrame, furnace: bool = False) -> DataFrame:
    """Alarm records with all fields; furnace alarms only need a non-blank id."""
    complete = has_keys(["puttime", "status", "alarmtext", "alarmcode"])
    if furnace:
        return df.where(complete & has_keys(["eqpid"]) & not_blank(field("eqpid")) & not_blank(field("puttime")))
    return df.where(complete & is_equipment_id(field("eqpid"))
                    & ~contains_ignoring_case(field("alarmtext"), CLEARED))


def alarm_action(df: DataFrame, message_type: str = "Alarm") -> DataFrame:
    cleared = contains_ignoring_case(field("alarmtext"), CLEARED)
    return df.select(
        field("eqpid").alias("machineid"),
        text_or_empty(field("puttime")).alias("occurtime"),
        text_or_empty(field("alarmcode")).alias("alarmid"),
        field("status").alias("machinestatus"),
        text_or_empty(field("alarmtext")).alias("alarmtext"),
        F.when(cleared, F.lit("D")).alias("serorclear"),
        F.lit(message_type).alias("messagetype"),
        F.lit(None).cast("string").alias("updatetime"),
        codes.alarm_factory(field("eqpid")).alias("factory"),
    )


def furnace_history(df: DataFrame) -> DataFrame:
    status = text_or_empty(field("status"))
    return df.select(
        field("eqpid").alias("name"),
        status.alias("statuscodename"), status.alias("newstatusname"), status.alias("oldstatusname"),
        F.lit(None).cast("string").alias("laststatusdate"),
        parse_mixed(field("puttime")).alias("oldstatusdate"),
        F.lit(None).cast("string").alias("usetime"),
        F.lit(None).cast("timestamp").alias("updatetime"),
    )


def furnace_outputs(df: DataFrame) -> dict[str, DataFrame]:
    """The three row types of a furnace alarm; cleared alarms cause no action."""
    records = alarm_records(df, furnace=True)
    return {
        "history": furnace_history(records),
        "action": alarm_action(records, "alarm").where("serorclear is null"),
        "update": status_update(records, "status", "puttime"),
    }
