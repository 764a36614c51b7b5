"""Nested measurement events: two shapes of one topic, and the defect feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import field, once
from ..functions.text import not_blank, strip

MATERIAL, STATE = "GP1", "GP2"

_MEAS_VALUE = "struct<`@Id`:string,`#text`:string>"
_EVENT = (
    "struct<EquipmentID:string,Data:struct<"
    "MtlEvtData:struct<"
    "JobMd:struct<`@ImageProcessingTime_ms`:string,`@ClassificationProcessingTime_ms`:string>,"
    "MtlEvt:struct<`@Name`:string,MtlList:struct<Mtl:struct<`@EqMtlId`:string,`@Come`:string,"
    f"MeasValsList:struct<MeasVals:struct<`@ToolId`:string,MeasVal:array<{_MEAS_VALUE}>>>>>>>,"
    "EqState:struct<Eq:struct<`@EqId`:string,States:struct<State:struct<`@Id`:string,`@Come`:string>>>>>>"
)

# Defect categories.
DEFECTS = ("dabing", "fenchen", "qiliu", "fabai", "fahong", "special color", "too bright", "too dark")


def measurement_events(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON events -> ``kind`` (GP1 material event, GP2 equipment state) and their fields.

    Events of neither shape, and events without equipment or time, are
    dropped. ``meas`` holds the measured values by id.
    """
    data = once(df, _e=F.from_json(value, _EVENT)).where("_e is not null")
    data = data.withColumn("kind", F.when(F.col("_e.Data.MtlEvtData").isNotNull(), F.lit(MATERIAL))
                           .when(F.col("_e.Data.EqState").isNotNull(), F.lit(STATE)))
    mtl = "_e.Data.MtlEvtData.MtlEvt.MtlList.Mtl"
    eq = "_e.Data.EqState.Eq"
    values = F.transform(
        F.col(f"{mtl}.MeasValsList.MeasVals.MeasVal"),
        lambda v: F.struct(v["@Id"].alias("key"),
                           strip(F.replace(v["#text"], F.lit("\\n"), F.lit(""))).alias("value")))
    # The last value of a repeated id stays.
    ids = F.transform(values, lambda v: v["key"])
    last = F.transform(F.array_distinct(ids), lambda k: F.element_at(F.filter(values, lambda v: v["key"] == k), -1))
    is_gp1 = F.col("kind") == MATERIAL
    out = data.select(
        *[c for c in df.columns if c != value],
        "kind",
        F.col("_e.EquipmentID").alias("EquipmentID"),
        F.when(is_gp1, F.col(f"{mtl}.`@Come`")).otherwise(F.col(f"{eq}.States.State.`@Come`")).alias("Come"),
        F.col("_e.Data.MtlEvtData.JobMd.`@ImageProcessingTime_ms`").alias("ImageProcessingTime_ms"),
        F.col("_e.Data.MtlEvtData.JobMd.`@ClassificationProcessingTime_ms`").alias("ClassificationProcessingTime_ms"),
        F.col("_e.Data.MtlEvtData.MtlEvt.`@Name`").alias("Name"),
        F.col(f"{mtl}.`@EqMtlId`").alias("EqMtlId"),
        F.col(f"{mtl}.MeasValsList.MeasVals.`@ToolId`").alias("ToolId"),
        F.map_from_entries(last).alias("meas"),
        F.col(f"{eq}.`@EqId`").alias("EqId"),
        F.col(f"{eq}.States.State.`@Id`").alias("StateId"),
    )
    return out.where(F.col("kind").isNotNull() & not_blank(F.col("EquipmentID")) & not_blank(F.col("Come")))


# The fields of either shape, in the names of the target table.
MATERIAL_FIELDS = ("EquipmentID", "ImageProcessingTime_ms", "ClassificationProcessingTime_ms", "Name",
                   "EqMtlId", "Come", "ToolId")
STATE_FIELDS = ("EquipmentID", "EqId", "StateId", "Come")


def material_cells(df: DataFrame) -> DataFrame:
    """Material events as one map per row: fixed fields, then the measured values."""
    fixed = F.create_map(*[p for n in MATERIAL_FIELDS for p in (F.lit(n), F.col(n))])
    measured = F.coalesce("meas", F.create_map().cast("map<string,string>"))
    # A measured value named like a field replaces it.
    kept = F.map_filter(fixed, lambda k, v: ~F.map_contains_key(measured, k))
    return df.where(F.col("kind") == MATERIAL).withColumn("cells", F.map_concat(kept, measured))


def state_cells(df: DataFrame) -> DataFrame:
    fixed = F.create_map(*[p for n in STATE_FIELDS for p in (F.lit(n), F.col(n))])
    return df.where(F.col("kind") == STATE).withColumn("cells", fixed)


def split_material_id(df: DataFrame, material: str = "eq_mtl_id") -> DataFrame:
    """24 or 25 character material ids -> ``tube_id, boat_id, area, site``.

    Offsets count from the first "-". Other lengths, and ids whose "-" comes
    too early or too late to hold all parts, are dropped.
    """
    mid = strip(F.col(material))
    dash = F.instr(mid, "-")
    long_id = (F.length(mid) == 25).cast("int")
    out = df.withColumn("_dash", dash).withColumn("_long", long_id).where(
        F.length(mid).isin(24, 25) & (dash >= 5) & (dash + 7 + long_id <= F.length(mid)))
    at = F.col("_dash")
    return out.select(
        *df.columns,
        mid.substr(at - 4, F.lit(6)).alias("tube_id"),
        mid.substr(at + 2, F.lit(5)).alias("boat_id"),
        mid.substr(at + 7, F.lit(1) + F.col("_long")).alias("area"),
        F.replace(mid.substr(at + 8 + F.col("_long"), F.lit(25)), F.lit("#"), F.lit("")).alias("site"),
    )


def defect_records(df: DataFrame, record: str = "rec") -> DataFrame:
    """Flattened defect feed -> equipment, material parts, classes and time."""
    whole = field("EquipmentID", record)
    cut = F.instr(whole, "-")
    fields = once(
        df,
        eqp_id=F.when(cut > 0, whole.substr(cut + 1, F.length(whole))).otherwise(F.lit("")),
        eq_mtl_id=F.regexp_replace(field("EqMtlId", record), r" +\S+", ""),
        cell_q=field("Cls_CellQ", record),
        col_q=field("Cls_ColQ", record),
        put_time=field("Come", record),
    ).drop(record)
    filled = F.lit(True)
    for name in ("eqp_id", "eq_mtl_id", "cell_q", "col_q", "put_time"):
        filled = filled & not_blank(F.col(name))
    known = F.lower("cell_q").isin(*DEFECTS) | F.lower("col_q").isin(*DEFECTS)
    return split_material_id(fields.where(filled & known)).drop("eq_mtl_id")
