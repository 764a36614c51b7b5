"""The jobs: a raw feed in, the rows for the sinks out.

A feed has ``value`` (one JSON text per row), ``seq`` (position in the source,
the tiebreak of equal times) and, for routed jobs, ``topic``. All functions
work on batch DataFrames; the stateless ones on streams too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import codes, keys
from ..functions.records import field, normalize_keys, once, parse_record
from ..functions.text import (format_second, is_date_time, is_equipment_id, not_blank, parse_second,
                              strip, text_or_empty)
from ..operators import (boats, brackets, counters, dedup, enrich, heartbeat, intervals, lookup,
                         measurements, modules, status, upsert, wide)
from ..operators.slices import SLICE_SECONDS
from ..operators.steps import STEP_RULES, StepRule, tag_step, tag_steps

Suffix = Callable[[Column], Column] | None
# Rules of the steps as constants of the plan or as a table.
Rules = tuple[StepRule, ...] | DataFrame


def parsed(feed: DataFrame, mapping: dict[str, str] | None = None, variant: str = "rename_lower",
           null_as_empty: bool = False) -> DataFrame:
    """JSON texts -> normalized record map ``rec``; malformed lines are left out (see ``rejected``)."""
    rows = once(feed, rec=parse_record(F.col("value"))).where("rec is not null").drop("value")
    return normalize_keys(rows, "rec", mapping, variant, null_as_empty)


def rejected(feed: DataFrame, time_field: str = "puttime", mapping: dict[str, str] | None = None) -> DataFrame:
    """The quarantine: every line a loader leaves out, with the reason."""
    rows = normalize_keys(once(feed, rec=parse_record(F.col("value"))), "rec", mapping)
    reason = (F.when(F.col("rec").isNull(), F.lit("malformed"))
              .when(~is_equipment_id(field("eqpid")), F.lit("bad_id"))
              .when(~not_blank(field(time_field)), F.lit("blank_time"))
              .when(parse_second(field(time_field)).isNull(), F.lit("bad_time")))
    return rows.select(*feed.columns, reason.alias("reason")).where("reason is not null")


# Loaders ------------------------------------------------------------------

def load_records(feed: DataFrame, mapping: dict[str, str] | None = None, time_field: str = "puttime",
                 suffix: Suffix = None, created: Column | None = None) -> DataFrame:
    """Generic and equipment-status loader: enriched record maps for a keyed table."""
    rows = enrich.valid_records(parsed(feed, mapping), time_field)
    return enrich.enrich_records(rows, time_field, suffix=suffix, created=created).where("ts is not null")


def load_routed(feed: DataFrame, tables: dict[str, str], mapping: dict[str, str] | None = None,
                suffix: Suffix = None, created: Column | None = None) -> DataFrame:
    """Multi-topic loader: as above, with the target table of each row."""
    rows = load_records(feed, mapping, suffix=suffix, created=created)
    rows = rows.withColumn("row_key", field("row_key"))
    return upsert.routed(rows, tables, {"default": "cf"})


def load_alarms(feed: DataFrame, mapping: dict[str, str] | None = None, suffix: Suffix = None) -> DataFrame:
    """Equipment alarms for a keyed table, with the tube that raised them."""
    rows = enrich.valid_records(parsed(feed, mapping))
    return enrich.match_alarm_tube(rows, suffix=suffix).where("ts is not null")


def status_outputs(feed: DataFrame, mapping: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Equipment status: history rows, and per device the latest status."""
    rows = status.status_records(parsed(feed, mapping, null_as_empty=True))
    updates = status.status_update(rows, order=("seq",)).where("laststatusdate is not null")
    return {
        "history": status.status_history(rows).where("laststatusdate is not null and oldstatusdate is not null"),
        "update": dedup.latest_per_key(updates, ["name"], ["laststatusdate", "seq"]).drop("seq"),
    }


def latest_status_updates(feed: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Latest status per device, with its position; on a stream in update mode."""
    rows = status.status_update(status.status_records(parsed(feed, mapping, null_as_empty=True)), order=("seq",))
    return dedup.latest_per_key(rows.where("laststatusdate is not null"), ["name"], ["laststatusdate", "seq"])


def alarm_actions(feed: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    return status.alarm_action(status.alarm_records(parsed(feed, mapping)))


def furnace_alarms(feed: DataFrame, mapping: dict[str, str] | None = None) -> dict[str, DataFrame]:
    return status.furnace_outputs(parsed(feed, mapping, null_as_empty=True))


def measurement_outputs(feed: DataFrame, suffix: Suffix = None) -> dict[str, DataFrame]:
    """Material events and equipment states, each as ``row_key, cells``."""
    events = measurements.measurement_events(feed)
    events = events.withColumn("row_key", keys.row_key(F.col("EquipmentID"), F.col("Come"), suffix=suffix))
    return {"material": measurements.material_cells(events), "state": measurements.state_cells(events)}


def tester_outputs(feed: DataFrame) -> dict[str, DataFrame]:
    rows = wide.parse_tester(feed)
    return {"full": wide.tester_full(rows), "detail": wide.tester_detail(rows)}


# Step efficiency ----------------------------------------------------------

def step_feed(feed: DataFrame, mapping: dict[str, str] | None = None, need_tube: bool = False,
              rules: Rules = STEP_RULES) -> DataFrame:
    """Tagged step rows; rows without a step are dropped."""
    rows = parsed(feed, mapping, "lower_rename")
    valid = is_equipment_id(field("eqpid")) & is_date_time(field("puttime"))
    if need_tube:
        valid = valid & not_blank(field("tubeid"))
    rows = once(
        rows.where(valid),
        eqpid=field("eqpid"), tubeid=text_or_empty(field("tubeid")), ts=parse_second(field("puttime")),
        site=codes.site_of(field("eqpid")), eqp_type=codes.device_type(field("eqpid")),
        runcount=text_or_empty(field("runcount")), states=text_or_empty(field("_states_")),
        _text=strip(field("_text1_")))
    if isinstance(rules, DataFrame):
        rows = tag_steps(rows, rules)
    else:
        rows = once(rows, step=tag_step(F.col("eqp_type"), F.col("_text"), rules))
    rows = rows.where("step is not null")
    return rows.select("eqpid", "tubeid", "ts", "seq", "site", "eqp_type", "runcount", "states", "step")


def _labelled(df: DataFrame) -> DataFrame:
    return df.select(
        "*", codes.factory_id(F.col("site")).alias("factory"), cal.day_date(F.col("ts")).alias("day_date"),
        format_second(F.col("ts")).alias("put_time"), format_second(F.col("end_ts")).alias("end_time"))


def step_efficiency(feed: DataFrame, dimension: DataFrame | None = None, mapping: dict[str, str] | None = None,
                    rules: Rules = STEP_RULES, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Step intervals with shift label and row key; with standard times where a dimension is given."""
    out = step_labels(intervals.step_intervals(step_feed(feed, mapping, rules=rules), slice_seconds=slice_seconds))
    return out if dimension is None else lookup.standard_times(out, dimension)


def step_labels(closed: DataFrame) -> DataFrame:
    raw = F.concat_ws("|", "eqpid", "put_time")
    return _labelled(closed).select(
        "*", cal.shift_label(F.col("ts"), F.col("site")).alias("shift"), F.lit("1").alias("output_qty"),
        F.concat_ws("|", keys.md5_prefix(raw), raw, F.when(F.trim("tubeid") != "", F.col("tubeid"))).alias("row_key"))


def step_efficiency_by_shift(feed: DataFrame, mapping: dict[str, str] | None = None,
                             rules: Rules = STEP_RULES, slice_seconds: int = SLICE_SECONDS,
                             open_until: Column | None = None) -> DataFrame:
    """Step intervals cut at shift switches; labels are those of each piece."""
    rows = step_feed(feed, mapping, need_tube=True, rules=rules)
    return shift_labels(intervals.step_intervals_by_shift(rows, slice_seconds=slice_seconds, open_until=open_until))


def shift_labels(pieces: DataFrame) -> DataFrame:
    return _labelled(pieces).select(
        "*", cal.shift_char(F.col("ts"), F.col("site")).alias("shift"),
        cal.year_label(F.col("day_date")).alias("year"), cal.month_label(F.col("day_date")).alias("month"),
        cal.week_label(F.col("day_date")).alias("week"),
        keys.row_key(F.col("eqpid"), F.col("put_time"), F.col("tubeid")).alias("row_key"))


# Benches, furnaces, boats -------------------------------------------------

def bench_efficiency(feed: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Wet bench: each module record closed by the next one of the module."""
    rows = modules.module_states(parsed(feed, mapping, "lower_rename"))
    done = intervals.record_intervals(rows, ["eqpid", "modulename"], F.col("modulename") == codes.TERMINAL_MODULE)
    return done.withColumn("end_time", text_or_empty(format_second(F.col("end_ts"))))


def bench_outputs(feed: DataFrame, mapping: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Bench with unload station: intervals of the modules, and the unload rows as they come."""
    rows = modules.module_states(parsed(feed, mapping, "lower_rename"))
    unload = F.col("modulename") == codes.TERMINAL_MODULE
    done = intervals.record_intervals(rows.where(~unload), ["eqpid", "modulename"])
    return {
        "1": done.withColumn("end_time", text_or_empty(format_second(F.col("end_ts")))).drop("end_ts"),
        "2": rows.where(unload).select("*", F.lit(0).cast("long").alias("ct"), F.lit("").alias("end_time")),
    }


def furnace_cycles(feed: DataFrame, emit_open: bool = False) -> DataFrame:
    rows = wide.parse_furnace_log(feed).where("ts is not null")
    pairs = intervals.cycle_pairs(rows, emit_open=emit_open)
    return pairs.withColumn("end_time", text_or_empty(format_second(F.col("end_ts"))))


def furnace_log_merge(feed: DataFrame, by: tuple[str, ...] = ("host", "path"),
                      timeout: int = brackets.TIMEOUT_SECONDS) -> DataFrame:
    """Log lines between recipe start and end as one text, incomplete ones told apart.

    ``by`` may be empty to merge all logs as a single one.
    """
    lines = brackets.parse_log_lines(feed).where("ts is not null")
    if not by:
        lines, by = lines.withColumn("all_logs", F.lit("")), ("all_logs",)
    return brackets.merge_brackets(lines, by, timeout=timeout)


def tube_boats(feed: DataFrame, version: int = 2, mapping: dict[str, str] | None = None,
               ttl_seconds: int | None = None) -> DataFrame:
    """Boats per snapshot. Version 1: boats in process; 2: any load state;
    3: as 2, after keeping one snapshot per device and set of run counts."""
    rows = boats.snapshot_records(parsed(feed, mapping, "lower_rename"))
    rows = rows.withColumn("ts", parse_second(field("puttime")))
    if version == 3:
        names = [f"_rc{n}" for n in range(1, 6)]
        rows = boats.with_run_counts(rows).select(
            "*", field("eqpid").alias("_eqp"),
            *[field(c).alias(n) for c, n in zip(boats.TUBE_COUNTERS, names)])
        by = ["_eqp", *names]
        rows = (dedup.first_per_key(rows, by) if ttl_seconds is None
                else dedup.first_within_ttl(rows, by, ttl_seconds)).drop(*by)
    out = boats.unpivot_boats(rows, processing_only=version == 1)
    return boats.enrich_boats(out, version == 1, F.col("ts"))


# Alarms -------------------------------------------------------------------

def defect_feed(feed: DataFrame) -> DataFrame:
    rows = once(feed, rec=parse_record(F.col("value"))).where("rec is not null").drop("value")
    out = measurements.defect_records(rows)
    return out.withColumn("ts", parse_second(F.col("put_time"))).where("ts is not null")


def defect_alarms(feed: DataFrame, threshold: int = counters.THRESHOLD) -> DataFrame:
    return counters.defect_threshold(defect_feed(feed), threshold=threshold)


def tester_silence(feed: DataFrame, devices: DataFrame, seconds: int, created: Column | None = None) -> DataFrame:
    return heartbeat.silence_alarms(heartbeat.parse_heartbeats(feed), devices, seconds, created=created)


def tester_clock_faults(feed: DataFrame, clock: Column | None = None) -> DataFrame:
    """The messages that ``tester_silence`` sets aside. ``clock`` as its ``created``."""
    return heartbeat.clock_faults(heartbeat.parse_heartbeats(feed), clock)
