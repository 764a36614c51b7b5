"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import codes, keys
from ..functions.records import field
from ..functions.text import format_second, hump_to_underscore, parse_second
from ..operators import (brackets, changes, counters, dedup, enrich, intervals, lookup, measurements,
                         modules, sequences, status, upsert, wide)
from ..operators.steps import STEP_RULES
from ..session import fresh_dir, prepare
from ..sources.tables import csv_table, csv_view_ddl
from . import feeds, jobs
from .sqlscript import Setting, Statement, run_script

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

LOADER_MAPPING = {"Tube2Text1": "text1"}
FIXED_NOW = "2024-02-01 00:00:00"
TABLES = {"view": "t_view", "click": "t_click", "purchase": "t_sale", "error": " "}
HALF = "2024-01-16 00:00:00"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return run


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.table(spark, sf_dir, "events")


def record_fields(df: DataFrame, *names: str) -> DataFrame:
    return df.select("seq", *[field(n).alias(n) for n in names])


# Loading and enrichment ----------------------------------------------------

@query
def normalize_filter(spark, sf_dir):
    rows = jobs.parsed(feeds.loader_feed(events_of(spark, sf_dir)), LOADER_MAPPING)
    rows = enrich.valid_records(rows).where(parse_second(field("puttime")).isNotNull())
    return record_fields(rows, "eqpid", "tubeid", "puttime", "text1", "runcount", "note")


@query
def normalize_snake(spark, sf_dir):
    rows = jobs.parsed(feeds.stepped_feed(events_of(spark, sf_dir)),
                       {"Tube2Text1": "text1", "EqpID": "eqp_id", "TubeID": "tube_id"}, "rename_snake")
    return record_fields(rows, "eqp_id", "tube_id", "put_time", "text1", "run_count").select(
        "*", hump_to_underscore(F.lit("OldStatusDate"), lower=False).alias("sample"))


@query
def rejected_lines(spark, sf_dir):
    return jobs.rejected(feeds.loader_feed(events_of(spark, sf_dir)), mapping=LOADER_MAPPING).select("seq", "reason")


@query
def enrich_standard(spark, sf_dir):
    rows = jobs.load_records(feeds.loader_feed(events_of(spark, sf_dir)), LOADER_MAPPING)
    return record_fields(rows, "eqpid", "site", "factory", "day_date", "shift", "long_time", "row_key")


@query
def calendar_labels(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderkey", feeds.pick(("G1", "Z2", "T1", "X1"), F.col("o_custkey")).alias("site"),
        cal.plus_seconds(F.col("o_orderdate").cast("timestamp"), (F.col("o_orderkey") * 600) % 86400).alias("ts"))
    ts, site = F.col("ts"), F.col("site")
    rows = rows.select("*", cal.day_date(ts).alias("day_date"))
    return rows.select(
        "o_orderkey", "site", "day_date", cal.shift_label(ts, site).alias("shift"),
        cal.shift_char(ts, site).alias("shift_char"), format_second(cal.next_switch(ts, site)).alias("next_switch"),
        cal.year_label(F.col("day_date")).alias("year"), cal.month_label(F.col("day_date")).alias("month"),
        cal.week_label(F.col("day_date")).alias("week"), codes.factory_id(site).alias("factory"))


@query
def routed_upsert(spark, sf_dir):
    feed = feeds.loader_feed(events_of(spark, sf_dir)).withColumnRenamed("event_type", "topic")
    rows = jobs.load_routed(feed, TABLES, LOADER_MAPPING)
    return rows.select("seq", "topic", "target", "family", "row_key")


# Step efficiency ------------------------------------------------------------

STEP_OUT = ["eqpid", "tubeid", "step", "step_name", "data_type", "put_time", "end_time", "ct", "runcount"]


@query
def step_intervals(spark, sf_dir):
    out = jobs.step_efficiency(feeds.stepped_feed(events_of(spark, sf_dir)), mapping=feeds.STEP_MAPPING)
    return out.select(*STEP_OUT, "run_count_next", "site", "factory", "day_date", "shift", "row_key", "states")


@query
def step_intervals_lookup(spark, sf_dir):
    dim = feeds.standard_time_table(feeds.table(spark, sf_dir, "customer"))
    out = jobs.step_efficiency(feeds.stepped_feed(events_of(spark, sf_dir)), dim, feeds.STEP_MAPPING)
    return out.select("eqpid", "tubeid", "put_time", "step", "ct", "st", "loss", "sertue",
                      "set_st", "set_st_loss", "set_st_sertue")


@query
def step_intervals_by_shift(spark, sf_dir):
    out = jobs.step_efficiency_by_shift(feeds.stepped_feed(events_of(spark, sf_dir)), feeds.STEP_MAPPING)
    return out.select(*STEP_OUT, format_second(F.col("orig_start")).alias("orig_start"), "day_date", "shift",
                      "year", "month", "week", "row_key")


@query
def step_rules_table(spark, sf_dir):
    rules = spark.createDataFrame([(k, r.eqp_type, r.kind, r.text, r.step) for k, r in enumerate(STEP_RULES)],
                                  "rule_no int, eqp_type string, kind string, text string, step string")
    out = jobs.step_efficiency(feeds.stepped_feed(events_of(spark, sf_dir)), mapping=feeds.STEP_MAPPING, rules=rules)
    return out.select(*STEP_OUT, "run_count_next", "site", "factory", "day_date", "shift", "row_key", "states")


# Benches, furnaces, boats ----------------------------------------------------

@query
def module_intervals(spark, sf_dir):
    out = jobs.bench_efficiency(feeds.module_feed(events_of(spark, sf_dir)))
    return out.select("eqpid", "modulename", "module_id", "e10state", "statuscode", "put_time", "end_time", "ct",
                      "factory", "day_date", "shift", "row_key")


@query
def bench_unload_split(spark, sf_dir):
    parts = jobs.bench_outputs(feeds.module_feed(events_of(spark, sf_dir)))
    out = [p.select(F.lit(name).alias("target"), "seq", "eqpid", "modulename", "put_time", "end_time", "ct")
           for name, p in parts.items()]
    return out[0].unionByName(out[1])


@query
def furnace_log_parse(spark, sf_dir):
    rows = wide.parse_furnace_log(feeds.furnace_feed(events_of(spark, sf_dir)))
    return rows.select("seq", "eqpid", "tubeid", "updatetime", "tube2_text1", "run_count", "e10state",
                       "datavar_all_recipe", "memory_all_text2", "boat_id")


@query
def cycle_pairs(spark, sf_dir):
    out = jobs.furnace_cycles(feeds.furnace_feed(events_of(spark, sf_dir)))
    return out.select("seq", "eqpid", "tubeid", "updatetime", "end_time", "boat_id")


BOAT_OUT = ["seq", "eqp_id", "put_time", "tube_id", "boat_id", "load_state", "recipe", "run_count", "cool_time",
            "day_date", "shift", "row_key"]


def _boats(version: int) -> Query:
    def run(spark, sf_dir):
        feed = feeds.boat_feed(feeds.table(spark, sf_dir, "lineitem"))
        return jobs.tube_boats(feed, version).select(*BOAT_OUT)

    run.__name__ = f"boat_unpivot_v{version}"
    return query(run)


for _version in (1, 2, 3):
    _boats(_version)


@query
def dedup_first(spark, sf_dir):
    rows = jobs.step_feed(feeds.stepped_feed(events_of(spark, sf_dir)), feeds.STEP_MAPPING)
    return dedup.first_per_key(rows, ["eqpid", "runcount"]).select(
        "eqpid", "runcount", "seq", format_second(F.col("ts")).alias("put_time"))


@query
def dedup_ttl(spark, sf_dir):
    rows = jobs.step_feed(feeds.stepped_feed(events_of(spark, sf_dir)), feeds.STEP_MAPPING)
    return dedup.first_within_ttl(rows, ["eqpid", "tubeid"], 2 * 86400).select(
        "eqpid", "tubeid", "seq", format_second(F.col("ts")).alias("put_time"))


@query
def bracket_merge(spark, sf_dir):
    out = jobs.furnace_log_merge(feeds.log_feed(events_of(spark, sf_dir)), timeout=3600)
    return out.select("host", "kind", format_second(F.col("begin_ts")).alias("begin_time"),
                      format_second(F.col("end_ts")).alias("end_time"), "n_lines", "text")


# Alarms ----------------------------------------------------------------------

@query
def silence_alarm(spark, sf_dir):
    out = jobs.tester_silence(
        feeds.heartbeat_feed(events_of(spark, sf_dir)),
        feeds.listed_devices(feeds.table(spark, sf_dir, "supplier")), 3600,
        F.lit(FIXED_NOW).cast("timestamp"))
    return out


# A clock that some of the given messages are ahead of.
SLOW_CLOCK = "2024-01-25 00:00:00"


@query
def tester_clock_faults(spark, sf_dir):
    out = jobs.tester_clock_faults(feeds.heartbeat_feed(events_of(spark, sf_dir)), F.lit(SLOW_CLOCK).cast("timestamp"))
    return out.select("eqp_id", format_second(F.col("ts")).alias("ts"), "reason")


@query
def defect_threshold(spark, sf_dir):
    out = jobs.defect_alarms(feeds.defect_lines(events_of(spark, sf_dir)))
    return out.select("seq", "boat_id", "cell_q", "col_q", "put_time",
                      *[counters.counter_name(d) for d in measurements.DEFECTS])


@query
def defect_window_counts(spark, sf_dir):
    rows = jobs.defect_feed(feeds.defect_lines(events_of(spark, sf_dir)))
    out = counters.defect_window_counts(rows, 3600)
    return out.select("boat_id", format_second(F.col("window_start")).alias("window_start"),
                      format_second(F.col("window_end")).alias("window_end"),
                      *[counters.counter_name(d) for d in measurements.DEFECTS])


@query
def material_id_split(spark, sf_dir):
    number = F.col("p_partkey")
    fill = feeds.pick(("", "A", "AB", "ABCDEFGHIJKLMNOP"), number)
    mid = F.concat(fill, F.lit("DF"), F.lpad((number % 100).cast("string"), 2, "0"), F.lit("-3BT"),
                   F.lpad((number % 1000).cast("string"), 4, "0"), F.lit("R"), F.lit("#Z2"), F.col("p_brand"))
    rows = feeds.table(spark, sf_dir, "part").select("p_partkey", mid.alias("eq_mtl_id"))
    return measurements.split_material_id(rows)


@query
def alarm_filter(spark, sf_dir):
    return jobs.alarm_actions(feeds.alarm_feed(events_of(spark, sf_dir)))


@query
def alarm_tube_match(spark, sf_dir):
    rows = jobs.load_alarms(feeds.plain_alarm_feed(events_of(spark, sf_dir)))
    return record_fields(rows, "eqpid", "status", "tubeid", "tubeid2", "row_key", "shift")


def _furnace(part: str) -> Query:
    def run(spark, sf_dir):
        out = jobs.furnace_alarms(feeds.alarm_feed(events_of(spark, sf_dir)))[part]
        stamps = [c for c in ("oldstatusdate", "laststatusdate") if dict(out.dtypes).get(c) == "timestamp"]
        return out.select(*[format_second(F.col(c)).alias(c) if c in stamps else
                            (F.col(c).cast("string").alias(c) if c == "updatetime" else F.col(c)) for c in out.columns])

    run.__name__ = f"furnace_alarm_{part}"
    return query(run)


for _part in ("history", "action", "update"):
    _furnace(_part)


@query
def status_history(spark, sf_dir):
    out = jobs.status_outputs(feeds.status_feed(events_of(spark, sf_dir)))["history"]
    return out.select("name", "statuscodename", "newstatusname", "oldstatusname",
                      format_second(F.col("laststatusdate")).alias("laststatusdate"),
                      format_second(F.col("oldstatusdate")).alias("oldstatusdate"), "tubeid")


@query
def latest_status(spark, sf_dir):
    out = jobs.status_outputs(feeds.status_feed(events_of(spark, sf_dir)))["update"]
    return out.select("name", "statuscodename", format_second(F.col("laststatusdate")).alias("laststatusdate"),
                      "prdtimeflag")


# Sequences ---------------------------------------------------------------------

BUY = sequences.Pattern(("start", "next"), ("event_type = 'view'", "event_type = 'purchase'"), 6 * 3600)
FUNNEL = sequences.Pattern(("first", "second", "third"),
                           ("event_type = 'view'", "event_type <> 'error'", "event_type = 'purchase'"), 24 * 3600)


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


@query
def sequence_match(spark, sf_dir):
    out = sequences.match_sequences(_user_events(spark, sf_dir), BUY, ["user_id"])
    return out.where("outcome = 'match'").select("user_id", "seq", F.col("events")[1]["seq"].alias("next_seq"))


@query
def sequence_timeout(spark, sf_dir):
    out = sequences.match_sequences(_user_events(spark, sf_dir), BUY, ["user_id"], flush_open=True)
    return out.where("outcome = 'timeout'").select("user_id", "seq", F.lit("timeout").alias("outcome"))


@query
def sequence_three_steps(spark, sf_dir):
    out = sequences.match_sequences(_user_events(spark, sf_dir), FUNNEL, ["user_id"])
    return out.select("user_id", "seq", "outcome", "matched", F.element_at("events", -1)["seq"].alias("last_seq"))


PATTERN_STEPS = """
SELECT * FROM VALUES
  ('buy', 1, CAST(NULL AS TIMESTAMP), 1, 'start', "event_type = 'view'", 21600), ('buy', 1, NULL, 2, 'next', "event_type = 'purchase'", 21600),
  ('buy', 2, TIMESTAMP'2024-01-16', 1, 'start', "event_type = 'click'", 43200), ('buy', 2, TIMESTAMP'2024-01-16', 2, 'next', "event_type = 'purchase'", 43200),
  ('funnel', 1, NULL, 1, 'first', "event_type = 'view'", 86400), ('funnel', 1, NULL, 2, 'second', "event_type <> 'error'", 86400),
  ('funnel', 1, NULL, 3, 'third', "event_type = 'purchase'", 86400),
  ('fault', 1, TIMESTAMP'2024-01-10', 1, 'start', "event_type = 'error'", 86400), ('fault', 1, TIMESTAMP'2024-01-10', 2, 'next', "event_type = 'error'", 86400)
AS t(pattern_id, version, valid_from, step_no, name, predicate, within_seconds)"""


@query
def sequence_many_patterns(spark, sf_dir):
    versions = sequences.pattern_versions(spark.sql(PATTERN_STEPS))
    out = sequences.match_patterns(_user_events(spark, sf_dir), versions, ["user_id"])
    return out.select("user_id", "seq", "pattern_id", "version", "outcome", "matched", "last_seq")


# Nested and wide records ---------------------------------------------------------

@query
def measurement_material(spark, sf_dir):
    out = jobs.measurement_outputs(feeds.measurement_feed(feeds.table(spark, sf_dir, "lineitem")))["material"]
    return out.select("seq", "row_key", *[F.try_element_at("cells", F.lit(n)).alias(n.lower()) for n in (
        *measurements.MATERIAL_FIELDS, "Cls_CellQ", "Qty")])


@query
def measurement_state(spark, sf_dir):
    out = jobs.measurement_outputs(feeds.measurement_feed(feeds.table(spark, sf_dir, "lineitem")))["state"]
    return out.select("seq", "row_key", *[F.try_element_at("cells", F.lit(n)).alias(n.lower())
                                          for n in measurements.STATE_FIELDS])


@query
def tester_wide(spark, sf_dir):
    return jobs.tester_outputs(feeds.tester_feed(feeds.table(spark, sf_dir, "lineitem")))["full"]


@query
def tester_detail(spark, sf_dir):
    return jobs.tester_outputs(feeds.tester_feed(feeds.table(spark, sf_dir, "lineitem")))["detail"]


@query
def order_type_codes(spark, sf_dir):
    part = feeds.table(spark, sf_dir, "part")
    text = F.concat_ws(" ", "p_name", feeds.pick(("", "by", "gsh", "cc", "LYcid", "yz"), F.col("p_partkey")))
    rows = part.select(codes.order_type(text).alias("order_type"),
                       codes.bin_type(F.col("p_size").cast("string")).alias("bin_type"),
                       codes.tester_factory(feeds.pick(("G1", "Z1", "Z2", "Z3", "T1", "X1"), F.col("p_partkey"))).alias("factory"))
    return rows.groupBy("order_type", "bin_type", "factory").agg(F.count("*").alias("n"))


# Change events and keyed tables ----------------------------------------------------

@query
def cdc_unpack(spark, sf_dir):
    rows = changes.parse_changes(feeds.change_feed(feeds.table(spark, sf_dir, "orders")))
    return changes.unpack_changes(rows).select("seq", "change", "side", "field", "field_value")


@query
def cdc_latest(spark, sf_dir):
    rows = changes.parse_changes(feeds.change_feed(feeds.table(spark, sf_dir, "orders")))
    out = changes.latest_state(rows, "id", ["ts", "seq"])
    return out.select("id", *[F.try_element_at("after", F.lit(n)).alias(n) for n in ("status", "priority")])


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse rows: each event type fills a column of its own."""
    kinds = ("view", "click", "purchase")
    return events_of(spark, sf_dir).select(
        F.concat(feeds.device_id(F.col("user_id")), F.lit("|"), feeds.tube_id(F.col("user_id"))).alias("row_key"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
        *[F.when(F.col("event_type") == k, F.col("event_id").cast("string")).alias(k) for k in kinds])


@query
def sparse_upsert(spark, sf_dir):
    return upsert.last_values(_cells(spark, sf_dir), ["row_key"], ["ts", "seq"])


@query
def keyed_merge(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    old = upsert.last_values(cells.where(F.col("ts") < HALF), ["row_key"], ["ts", "seq"])
    new = upsert.last_values(cells.where(F.col("ts") >= HALF).drop("click"), ["row_key"], ["ts", "seq"])
    return upsert.merge_rows(old, new, ["row_key"])


@query
def delete_by_key(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    kept = upsert.last_values(cells, ["row_key"], ["ts", "seq"])
    gone = events_of(spark, sf_dir).where((F.col("event_type") == "error") & (F.col("value") > 60)).select(
        F.concat(feeds.device_id(F.col("user_id")), F.lit("|"), feeds.tube_id(F.col("user_id"))).alias("row_key"))
    return upsert.without_keys(kept, gone, ["row_key"]).select("row_key", "view")


# SQL scripts -------------------------------------------------------------------------

@query
def sql_filter(spark, sf_dir):
    rows = jobs.parsed(feeds.stepped_feed(events_of(spark, sf_dir)), variant="lower")
    record_fields(rows, "eqpid", "puttime", "state").createOrReplaceTempView("eqp_alarm")
    return run_script(spark, [Statement(
        "SELECT seq, eqpid, puttime, state AS status FROM eqp_alarm WHERE state = 'purchase'")])[-1]


@query
def sql_cast(spark, sf_dir):
    rows = jobs.parsed(feeds.alarm_feed(events_of(spark, sf_dir)), variant="lower")
    record_fields(rows, "eqpid", "alarmcode", "status").createOrReplaceTempView("eqp_state_alarm")
    return run_script(spark, [
        Statement("SELECT seq, eqpid, cnt FROM parsed_alarm WHERE try_cast(substr(status, 2) AS INT) = 0", 2),
        Statement("CREATE OR REPLACE TEMPORARY VIEW parsed_alarm AS "
                  "SELECT seq, eqpid, status, try_cast(alarmcode AS INT) AS cnt FROM eqp_state_alarm", 1),
    ])[-1]


@query
def script_insert(spark, sf_dir):
    """Tables made and filled by statements: a Parquet table of alarms and a CSV table of counts, read back together."""
    rows = jobs.parsed(feeds.alarm_feed(events_of(spark, sf_dir)), variant="lower")
    record_fields(rows, "eqpid", "alarmcode", "status").createOrReplaceTempView("alarm_lines")
    root = fresh_dir(spark, "script")
    return run_script(spark, [
        Statement("CREATE TABLE alarms_${job.run} (seq BIGINT, eqpid STRING, code INT, status STRING) USING parquet LOCATION '${job.root}/alarms'", 1),
        Statement("INSERT INTO alarms_${job.run} SELECT seq, eqpid, try_cast(alarmcode AS INT), status FROM alarm_lines WHERE seq % 2 = 0", 2),
        Statement("INSERT INTO alarms_${job.run} SELECT seq, eqpid, try_cast(alarmcode AS INT), status FROM alarm_lines WHERE seq % 2 = 1", 3),
        Statement("CREATE TABLE counts_${job.run} (eqpid STRING, status STRING, n BIGINT) USING csv OPTIONS (quote '\"') LOCATION '${job.root}/counts'", 4),
        Statement("INSERT INTO counts_${job.run} SELECT eqpid, status, count(*) FROM alarms_${job.run} WHERE code >= ${job.least} GROUP BY eqpid, status", 5),
        Statement("SELECT c.eqpid, c.status, c.n, a.last_seq FROM counts_${job.run} c JOIN "
                  "(SELECT eqpid, status, max(seq) AS last_seq FROM alarms_${job.run} GROUP BY eqpid, status) a USING (eqpid, status)", 6),
    ], [Setting("job.root", "string", root), Setting("job.run", "string", root[-12:]), Setting("job.least", "int", " 50 "),
        Setting("spark.sql.variable.substitute", "boolean", "TRUE")])[-1]


@query
def csv_scan(spark, sf_dir):
    """CSV files without header, written with a quote of their own: declared text columns, and a view of a script on the same files."""
    path, columns = f"{fresh_dir(spark, 'csv')}/orders", ["orderkey", "status", "note"]
    orders = feeds.table(spark, sf_dir, "orders")
    orders.select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.concat_ws(", ", "o_orderpriority", F.lit("it's \"so\"")))) \
        .write.option("quote", "'").csv(path)
    csv_table(spark, path, columns, "'").createOrReplaceTempView("csv_rows")
    return run_script(spark, [
        Statement(csv_view_ddl("csv_view", path, columns, "'"), 1),
        Statement("SELECT r.orderkey, r.status, r.note, v.n FROM csv_rows r JOIN "
                  "(SELECT status, count(note) AS n FROM csv_view GROUP BY status) v USING (status)", 2)])[-1]
