"""Registered streaming queries: each one runs over the whole event table and
returns what it wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.records import field
from ..functions.text import format_second
from ..operators import brackets, changes, heartbeat, lookup, measurements, sequences, wide
from ..operators.counters import counter_adds, counter_name
from ..session import fresh_dir
from ..sinks.changed import apply_changes, live_rows
from ..sinks.keyed import DELETE, KeyedTable, columns_of_map, put_records, put_routed
from ..sinks.topics import as_json, write_topic_files
from ..sources.tables import DEVICE_REFRESH_SECONDS, Refreshing
from ..sources.topics import json_view, map_batches, read_topic_folders, stream_table
from ..streaming import builtin, carry, counting, processors
from ..streaming.options import StreamOptions
from ..streaming.runner import CommittedSinks, run_fan_out, run_job
from . import feeds, jobs
from .queries import BUY, FIXED_NOW, HALF, LOADER_MAPPING, SLOW_CLOCK, STEP_OUT, TABLES, events_of, query
from .sqlscript import Statement, run_script


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(spark, f"{sf_dir}/events.parquet")


#: Rows of a file of a cut stream; a micro-batch of more is several files, so that several tasks write and read it.
FILE_ROWS = 50_000


def cut_stream(df: DataFrame, label: str, parts: int = 3, jitter_seconds: int = 0, ts: str = "ts", seq: str = "event_id",
               file_rows: int = FILE_ROWS) -> DataFrame:
    """The rows of ``df`` as a stream of ``parts`` micro-batches, each of equally many files.

    Micro-batches follow one another in time; a row may come up to ``jitter_seconds``
    too late for its place.
    """
    spark = df.sparkSession
    folder = f"{fresh_dir(spark, label)}/in"
    late = F.pmod(F.xxhash64(seq), F.lit(jitter_seconds)) if jitter_seconds else F.lit(0)
    at = F.unix_timestamp(F.col(ts).cast("timestamp"))
    first, last, rows = df.agg(F.min(at), F.max(at), F.count("*")).first()
    span = max(1, last - first + 1) if first is not None else 1
    part = F.least(F.floor((at + late - F.lit(first)) * parts / span), F.lit(parts - 1))
    files = max(1, -(-rows // (parts * file_rows)))
    for k in range(parts):
        # One after the other, as a stream of files takes them by age.
        of_part = df.where(F.coalesce(part, F.lit(0)) == k)
        of_part = of_part.coalesce(1) if files == 1 else of_part.repartition(files)
        of_part.write.mode("append").parquet(folder)
        # A task without rows writes no file: empty ones fill up the micro-batch, or it would take some of the next.
        for _ in range(files * (k + 1) - len(spark.read.schema(df.schema).parquet(folder).inputFiles())):
            df.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return stream_table(spark, folder, df.schema, max_files=files)


def to_table(stream: DataFrame, label: str, single_batch: bool = False) -> DataFrame:
    """Run an append stream to the end and read its output."""
    spark = stream.sparkSession
    root = fresh_dir(spark, label)
    run = (StreamOptions(f"{root}/checkpoint", single_batch=single_batch).apply(stream).outputMode("append")
           .format("parquet").option("path", f"{root}/out").start())
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def through_carry(stream: DataFrame, step: carry.Step, label: str, delay_seconds: int = 120) -> DataFrame:
    spark = stream.sparkSession
    root = fresh_dir(spark, label)
    sink = carry.parquet_sink(f"{root}/out")
    run = carry.run_ordered(stream, step, sink, f"{root}/carry", StreamOptions(f"{root}/checkpoint"), delay_seconds).start()
    run.awaitTermination()
    carry.flush(spark, step, sink, f"{root}/carry")
    return spark.read.parquet(f"{root}/out").drop("batch")


@query
def stream_step_intervals(spark, sf_dir):
    rows = jobs.step_feed(feeds.stepped_feed(event_stream(spark, sf_dir)), feeds.STEP_MAPPING)
    out = through_carry(rows, carry.step_interval_step(), "step-intervals")
    return jobs.step_labels(out).select(*STEP_OUT, "run_count_next", "row_key")


@query
def stream_step_intervals_by_shift(spark, sf_dir):
    rows = jobs.step_feed(feeds.stepped_feed(event_stream(spark, sf_dir)), feeds.STEP_MAPPING, need_tube=True)
    out = through_carry(rows, carry.shift_interval_step(), "shift-intervals")
    return jobs.shift_labels(out).select(*STEP_OUT, "shift", "row_key", format_second(F.col("orig_start")).alias("orig_start"))


# Columns of the loaded table: every entry of a record.
LOADED = ["eqpid", "tubeid", "puttime", "text1", "runcount", "note", "site", "factory", "shift", "long_time", "create_time"]


def _stored(feed: DataFrame, names: list[str], mapping: dict[str, str] | None = None, time_field: str = "puttime") -> DataFrame:
    """Loaded records as rows of a keyed table."""
    rows = jobs.load_records(feed, mapping, time_field, created=F.lit(FIXED_NOW))
    return columns_of_map(rows.withColumn("row_key", field("row_key")).drop("event_type"), names=["day_date", *names])


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(feeds.loader_feed(events_of(spark, sf_dir)), LOADED, LOADER_MAPPING)


def _through_table(stream: DataFrame, job, label: str, names: list[str]) -> DataFrame:
    spark = stream.sparkSession
    root = fresh_dir(spark, label)
    table = KeyedTable(spark, f"{root}/table", partition="day_date")
    run_job(stream, job, {"out": lambda df, n: table.put(df, ["ts", "seq"], n)}, StreamOptions(f"{root}/checkpoint")).start().awaitTermination()
    return table.read(["row_key", "day_date", *names])


@query
def stream_keyed_load(spark, sf_dir):
    return _through_table(event_stream(spark, sf_dir), lambda batch: _stored(feeds.loader_feed(batch), LOADED, LOADER_MAPPING),
                          "keyed-load", LOADED)


STATUS = ["eqpid", "tubeid", "newtime", "newstatus", "oldstatus", "oldtime", "site", "factory", "shift", "long_time", "create_time"]


@query
def stream_keyed_status(spark, sf_dir):
    """Equipment status into a keyed table by the time of the new status, in three micro-batches."""
    return _through_table(cut_stream(events_of(spark, sf_dir), "keyed-status"),
                          lambda batch: _stored(feeds.status_feed(batch), STATUS, time_field="newtime"), "keyed-status", STATUS)


TARGETS = sorted({t for t in TABLES.values() if t.strip()})


def _read_routed(spark: SparkSession, root: str) -> DataFrame:
    read = [KeyedTable(spark, f"{root}/{t}", partition="day_date").read(["row_key", "day_date", *LOADED]).withColumn("target", F.lit(t))
            for t in TARGETS]
    return reduce(DataFrame.unionByName, read)


@query
def keyed_put(spark, sf_dir):
    """Two batches into one table, the first of them replayed."""
    rows = _loaded(spark, sf_dir)
    table = KeyedTable(spark, f"{fresh_dir(spark, 'keyed-put')}/table", partition="day_date")
    for batch_id in (0, 1, 0):
        put_records(table, rows.where(F.col("seq") % 2 == batch_id), order=["ts", "seq"], batch_id=batch_id)
    return table.read(["row_key", "day_date", *LOADED])


@query
def keyed_delete(spark, sf_dir):
    rows = _loaded(spark, sf_dir)
    table = KeyedTable(spark, f"{fresh_dir(spark, 'keyed-delete')}/table", partition="day_date")
    put_records(table, rows, order=["ts", "seq"])
    put_records(table, rows.where(F.col("runcount").cast("int") % 5 == 0), operation=DELETE)
    return table.read(["row_key", "day_date", *LOADED])


@query
def keyed_routed(spark, sf_dir):
    feed = feeds.loader_feed(events_of(spark, sf_dir)).withColumnRenamed("event_type", "topic")
    root = fresh_dir(spark, "keyed-routed")
    put_routed(spark, root, jobs.load_routed(feed, TABLES, LOADER_MAPPING, created=F.lit(FIXED_NOW)), TARGETS, names=["day_date", *LOADED])
    return _read_routed(spark, root)


@query
def stream_keyed_routed(spark, sf_dir):
    """Topics of every micro-batch into their tables; the last batch is replayed."""
    root = fresh_dir(spark, "stream-routed")
    last = []

    def route(batch: DataFrame, batch_id: int) -> None:
        feed = feeds.loader_feed(batch).withColumnRenamed("event_type", "topic")
        rows = jobs.load_routed(feed, TABLES, LOADER_MAPPING, created=F.lit(FIXED_NOW))
        put_routed(spark, root, rows, TARGETS, batch_id=batch_id, names=["day_date", *LOADED])
        last[:] = [batch_id]

    StreamOptions(f"{root}/checkpoint").apply(cut_stream(events_of(spark, sf_dir), "stream-routed")).foreachBatch(
        map_batches(route)).start().awaitTermination()
    route(events_of(spark, sf_dir), last[0])
    return _read_routed(spark, root)


@query
def keyed_own_key(spark, sf_dir):
    """Records with a digest of three entries as key suffix, converted by a function of the caller on their way into the table."""
    suffix = keys.content_suffix(field("eqpid"), field("puttime"), field("runcount"))
    rows = jobs.load_records(feeds.loader_feed(events_of(spark, sf_dir)), LOADER_MAPPING, suffix=suffix)

    def convert(records: DataFrame) -> DataFrame:
        return records.select(field("row_key").alias("row_key"), field("day_date").alias("day_date"), "ts", "seq",
                              F.to_json(F.map_filter("rec", lambda k, v: k.isin("eqpid", "puttime"))).alias("record"),
                              field("runcount").cast("int").alias("runcount"))

    table = KeyedTable(spark, f"{fresh_dir(spark, 'own-key')}/table", partition="day_date")
    put_records(table, rows, convert, order=["ts", "seq"])
    return table.read(["row_key", "day_date", "record", "runcount"])


@query
def stream_topic_sink(spark, sf_dir):
    """Loaded records as JSON texts into the files of a topic, a folder per micro-batch, the first of them written again."""
    root = fresh_dir(spark, "topic-sink")
    stream = cut_stream(events_of(spark, sf_dir), "topic-sink")

    def send(batch: DataFrame, batch_id: int) -> None:
        rows = jobs.load_records(feeds.loader_feed(batch), LOADER_MAPPING)
        out = as_json(rows.select("seq", *[field(n).alias(n) for n in ("eqpid", "puttime", "text1", "note", "row_key")]))
        for _ in range(2 if batch_id == 0 else 1):
            write_topic_files(out, root, "loaded", batch_id)

    StreamOptions(f"{root}/checkpoint").apply(stream).foreachBatch(map_batches(send)).start().awaitTermination()
    sent = spark.read.text(f"{root}/loaded").select(F.from_json(
        "value", "seq long, eqpid string, puttime string, text1 string, note string, row_key string").alias("r"))
    return sent.select("r.*")


@query
def stream_cycle_pairs(spark, sf_dir):
    rows = wide.parse_furnace_log(feeds.furnace_feed(event_stream(spark, sf_dir))).where("ts is not null")
    out = through_carry(rows, carry.record_interval_step(["eqpid", "tubeid"]), "cycle-pairs")
    return out.select("seq", "eqpid", "tubeid", "updatetime", format_second(F.col("end_ts")).alias("end_time"),
                      "ct", "boat_id")


@query
def stream_bracket_merge(spark, sf_dir):
    rows = brackets.parse_log_lines(feeds.log_feed(event_stream(spark, sf_dir))).where("ts is not null")
    out = through_carry(rows, carry.bracket_step(timeout=3600), "bracket-merge")
    return out.select("host", "kind", format_second(F.col("begin_ts")).alias("begin_time"),
                      format_second(F.col("end_ts")).alias("end_time"), "n_lines", "text")


@query
def stream_window_alarm(spark, sf_dir):
    beats = heartbeat.parse_heartbeats(feeds.heartbeat_feed(event_stream(spark, sf_dir))).withColumn("ok", F.lit(1))
    out = to_table(builtin.window_alarms(beats, None, 3600), "window-alarm")
    return heartbeat.alarms(out, F.lit("2024-02-01 00:00:00").cast("timestamp")).select(
        "eqp_id", "begin_time", "end_time", "status", "cnt", "alarm_id")


@query
def stream_dedup(spark, sf_dir):
    rows = jobs.step_feed(feeds.stepped_feed(event_stream(spark, sf_dir)), feeds.STEP_MAPPING)
    out = through_carry(rows, carry.dedup_step(["eqpid", "tubeid"], 2 * 86400), "dedup")
    return out.select("eqpid", "tubeid", "seq", format_second(F.col("ts")).alias("put_time"))


@query
def stream_lookup(spark, sf_dir):
    rows = jobs.step_feed(feeds.stepped_feed(event_stream(spark, sf_dir)), feeds.STEP_MAPPING)
    rows = rows.withColumn("ct", F.col("runcount").cast("long") * 100)
    dim = Refreshing(lambda: feeds.standard_time_table(feeds.table(spark, sf_dir, "customer")))
    root = fresh_dir(spark, "lookup")
    sink = carry.parquet_sink(f"{root}/out")
    run = StreamOptions(f"{root}/checkpoint").apply(rows).foreachBatch(
        map_batches(lambda batch, n: sink(lookup.standard_times(batch, dim.get()), n))).start()
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("seq", "eqpid", "tubeid", "ct", "st", "loss", "sertue")


@query
def stream_defect_counters(spark, sf_dir):
    rows = jobs.defect_feed(feeds.defect_lines(event_stream(spark, sf_dir)))
    out = through_carry(rows, carry.defect_step(), "defect-counters", delay_seconds=60)
    return out.select("seq", "boat_id", "cell_q", "col_q", "put_time", *[counter_name(d) for d in measurements.DEFECTS])


#: Hits within two hours of one another at which the given events, sparse as they are, alarm.
TTL_THRESHOLD = 3


@query
def stream_defect_counters_ttl(spark, sf_dir):
    stream = cut_stream(events_of(spark, sf_dir), "defect-ttl", parts=3, jitter_seconds=50)
    rows = jobs.defect_feed(feeds.defect_lines(stream))
    out = to_table(counting.ttl_counters(rows, "boat_id", counter_adds(), ["cell_q", "col_q", "put_time"], TTL_THRESHOLD), "defect-ttl")
    return out.select("seq", "boat_id", "cell_q", "col_q", "put_time", *[counter_name(d) for d in measurements.DEFECTS])


@query
def stream_silence_alarm(spark, sf_dir):
    stream = cut_stream(events_of(spark, sf_dir), "silence", parts=3, jitter_seconds=90)
    beats = heartbeat.parse_heartbeats(feeds.heartbeat_feed(stream)).where(heartbeat.clock_fault(F.col("ts")).isNull())
    devices = Refreshing(lambda: feeds.listed_devices(feeds.table(spark, sf_dir, "supplier")), DEVICE_REFRESH_SECONDS)
    out = through_carry(beats, carry.silence_window_step(devices, 3600), "silence")
    return heartbeat.alarms(out, F.lit(FIXED_NOW).cast("timestamp"))


@query
def stream_cdc_apply(spark, sf_dir):
    """Change files in no order, the second batch replayed after the run."""
    orders = feeds.table(spark, sf_dir, "orders")
    root = fresh_dir(spark, "cdc-apply")
    parts = 3
    for k in range(parts):
        orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(parts)) == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
    table = KeyedTable(spark, f"{root}/table", key="id", partition="part")
    replay = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = changes.parse_changes(feeds.change_feed(batch))
        image = F.coalesce("after", "before")
        rows = rows.select(image["id"].alias("id"), *[F.try_element_at("after", F.lit(n)).alias(n) for n in ("status", "priority")], "ts", "seq", "op")
        rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(8)))
        replay.append(apply_changes(table, rows, ["ts", "seq"], F.col("op") == "d", batch_id))

    StreamOptions(f"{root}/checkpoint").apply(stream_table(spark, f"{root}/in", orders.schema, max_files=1)).foreachBatch(
        map_batches(apply)).start().awaitTermination()
    apply(orders, 1)
    if replay != [True] * parts + [False]:
        raise RuntimeError(f"batches were applied as {replay}")
    return live_rows(table, ["id", "status", "priority"])


@query
def stream_latest_status(spark, sf_dir):
    """State per device in update mode: a batch brings the devices that changed, the table keeps their latest."""
    stream = cut_stream(events_of(spark, sf_dir), "latest-status", parts=3, jitter_seconds=7 * 86400)
    root = fresh_dir(spark, "latest-status")
    table = KeyedTable(spark, f"{root}/table", key="name", partition="part")
    latest = jobs.latest_status_updates(feeds.status_feed(stream)).withColumn("part", F.pmod(F.xxhash64("name"), F.lit(8)))
    StreamOptions(f"{root}/checkpoint").apply(latest).outputMode("update").foreachBatch(
        lambda batch, n: apply_changes(table, batch, ["laststatusdate", "seq"], F.lit(False), n)).start().awaitTermination()
    return live_rows(table, ["name", "statuscodename", "laststatusdate", "prdtimeflag"]).withColumn(
        "laststatusdate", format_second(F.col("laststatusdate")))


@query
def stream_sql_filter(spark, sf_dir):
    """A stream with a declared schema as a view, queried by a script."""
    json_view(spark, feeds.stepped_feed(cut_stream(events_of(spark, sf_dir), "sql-filter")), "eqp_stream", "EqpID STRING, PutTime STRING, State STRING", ["seq"])
    rows = run_script(spark, [
        Statement("SELECT seq, eqpid, puttime, status FROM eqp_purchase", 2),
        Statement("CREATE OR REPLACE TEMPORARY VIEW eqp_purchase AS "
                  "SELECT seq, EqpID AS eqpid, PutTime AS puttime, State AS status FROM eqp_stream WHERE State = 'purchase'", 1),
    ])[-1]
    return to_table(rows, "sql-filter")


@query
def stream_topics(spark, sf_dir):
    """Three topics by pattern in two runs; the third folder and more files appear between them."""
    root = fresh_dir(spark, "topics")
    events = events_of(spark, sf_dir)
    first = F.col("event_id") % 2 == 0

    def publish(topic: str, condition) -> None:
        events.where((F.col("event_type") == topic) & condition).write.mode("append").parquet(f"{root}/in/{topic}")

    def run() -> None:
        rows = read_topic_folders(spark, f"{root}/in", "view|click|purchase", events.schema, is_pattern=True).select("topic", "event_id", "user_id", "value")
        StreamOptions(f"{root}/checkpoint").apply(rows).outputMode("append").format("parquet").option("path", f"{root}/out").start().awaitTermination()

    for topic in ("view", "click", "error"):
        publish(topic, first)
    run()
    publish("purchase", F.lit(True))
    for topic in ("view", "click", "error"):
        publish(topic, ~first)
    run()
    return spark.read.parquet(f"{root}/out")


@query
def stream_fan_out(spark, sf_dir):
    """Loaded and rejected lines of every micro-batch, committed together."""
    root = fresh_dir(spark, "fan-out")
    sinks = CommittedSinks(spark, f"{root}/out")

    def job(batch: DataFrame) -> dict[str, DataFrame]:
        feed = feeds.loader_feed(batch)
        return {"loaded": jobs.load_records(feed, LOADER_MAPPING).select("seq", field("row_key").alias("detail")),
                "rejected": jobs.rejected(feed, mapping=LOADER_MAPPING).select("seq", F.col("reason").alias("detail"))}

    run_fan_out(cut_stream(events_of(spark, sf_dir), "fan-out"), job, sinks, StreamOptions(f"{root}/checkpoint")).start().awaitTermination()
    return reduce(DataFrame.unionByName, [sinks.read(n).select(F.lit(n).alias("target"), "seq", "detail") for n in ("loaded", "rejected")])


@query
def stream_late_rows(spark, sf_dir):
    """Two files, the younger half first: the older half is late, and what lies a day past the clock is ahead."""
    root = fresh_dir(spark, "late-rows")
    events = events_of(spark, sf_dir)
    for older in (False, True):
        events.where((F.col("ts").cast("timestamp") < HALF) == older).coalesce(1).write.mode("append").parquet(f"{root}/in")
    rows = stream_table(spark, f"{root}/in", events.schema, max_files=1).select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("eqpid"))
    clock = spark.range(1).select(F.unix_timestamp(F.lit(SLOW_CLOCK).cast("timestamp"))).first()[0]
    carry.run_ordered(rows, carry.dedup_step(["eqpid"]), carry.parquet_sink(f"{root}/out"), f"{root}/carry", StreamOptions(f"{root}/checkpoint"),
                      120, clock=lambda: float(clock)).start().awaitTermination()
    return carry.set_aside(spark, f"{root}/carry", rows.schema).select("seq", "eqpid", "reason", "batch")


@query
def stream_sequences(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    out = to_table(processors.find_sequences(rows, BUY, "user_id"), "sequences")
    return out.select(F.col("key").cast("long").alias("user_id"), "seq", "outcome", "last_seq")
