"""Silence alarms: which devices sent nothing in a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import codes
from ..functions.records import once
from ..functions.text import format_second, not_blank

HEARTBEAT_FORMAT = "dd-MM-yyyy HH:mm:ss"
ALARM_FIELDS = ("alarm_id", "factory", "site", "eqp_id", "sub_process", "begin_time", "end_time",
                "status", "cnt", "msg", "create_time")


def parse_heartbeats(df: DataFrame, value: str = "value") -> DataFrame:
    """Tester lines -> ``eqp_id, ts``; lines without id, date or time are dropped."""
    rows = once(df, _d=F.from_json(value, "struct<data:struct<eqp_id:string,TestDate:string,TestTime:string>>")["data"])
    eqp, day, time = F.col("_d.eqp_id"), F.col("_d.TestDate"), F.col("_d.TestTime")
    rows = rows.where(not_blank(eqp) & not_blank(day) & not_blank(time))
    rows = once(rows, eqp_id=eqp, ts=F.try_to_timestamp(F.concat_ws(" ", day, time), F.lit(HEARTBEAT_FORMAT)))
    return rows.where("ts is not null").drop(value, "_d")


# Clocks that were reset count on from their default date (1970, 1980, 2000), wrong ones may stand years ahead.
EARLIEST = "2001-01-01 00:00:00"
AHEAD_SECONDS = 86_400
# Windows per array when they are listed.
AT_ONCE = 1_000


def clock_fault(ts: Column, clock: Column | None = None) -> Column:
    """``ahead`` for a time over a day ahead of the clock, ``default`` for one at a default date, else null."""
    clock = F.current_timestamp() if clock is None else clock
    ahead = F.unix_timestamp(ts) > F.unix_timestamp(clock) + AHEAD_SECONDS
    return F.when(ahead, "ahead").when(ts < F.lit(EARLIEST).cast("timestamp"), "default")


def clock_faults(beats: DataFrame, clock: Column | None = None) -> DataFrame:
    """Messages that set no bounds and take no part in the alarms without bounds: eqp_id, ts, reason."""
    return beats.select("eqp_id", "ts", clock_fault(F.col("ts"), clock).alias("reason")).where("reason is not null")


def window_of(ts: Column, seconds: int) -> Column:
    """Tumbling window aligned to the epoch; the plant clock is ahead of it."""
    return F.window(ts, f"{seconds} seconds", startTime=f"{cal.PLANT_UTC_OFFSET % seconds} seconds")


def window_status(events: DataFrame, seconds: int) -> DataFrame:
    """Per device and window: ``cnt`` real messages and ``status`` 1 when there were any.

    ``events`` carries ``ok``: 1 for a real message, 0 for an expected device.
    """
    counted = events.groupBy("eqp_id", window_of(F.col("ts"), seconds).alias("w")).agg(
        F.sum("ok").cast("int").alias("cnt"))
    return counted.withColumn("status", (F.col("cnt") > 0).cast("int"))


def expected_beats(devices: DataFrame, start: Column, end: Column, seconds: int) -> DataFrame:
    """One placeholder per listed device and window from ``start`` to ``end``."""
    shift = cal.PLANT_UTC_OFFSET % seconds
    first = F.floor((F.unix_timestamp(start) - shift) / seconds) * seconds + shift
    last = F.unix_timestamp(end)
    # A long span goes part by part, never as one array.
    parts = devices.select("eqp_id", last.alias("_last"), F.explode(F.sequence(first, last, F.lit(seconds * AT_ONCE).cast("long"))).alias("_part"))
    marks = F.sequence("_part", F.least(F.col("_last"), F.col("_part") + seconds * (AT_ONCE - 1)), F.lit(seconds).cast("long"))
    return parts.select("eqp_id", F.explode(marks).alias("s")).select(
        "eqp_id", F.timestamp_seconds("s").alias("ts"), F.lit(0).alias("ok"))


def alarms(status: DataFrame, created: Column | None = None) -> DataFrame:
    """Window results as alarm records. The id is a digest of device and window."""
    eqp = F.col("eqp_id")
    site = codes.site_of(eqp)
    begin, end = F.col("w.start"), F.col("w.end")
    created = F.current_timestamp() if created is None else created
    salt = F.upper(F.substring(F.md5(F.concat_ws("|", eqp, format_second(begin))), 1, 4))
    alarm_id = F.concat(F.date_format(created, "yyMMddHHmm"), F.replace(eqp, F.lit("-"), F.lit("")),
                        F.lpad(F.col("status").cast("string"), 2, "0"), salt)
    return status.select(
        alarm_id.alias("alarm_id"),
        codes.factory_id(site).alias("factory"),
        site.alias("site"),
        "eqp_id",
        eqp.alias("sub_process"),
        format_second(begin).alias("begin_time"),
        format_second(end).alias("end_time"),
        "status", "cnt",
        F.when(F.col("status") == 0,
               F.concat(F.lit("No message received for a long time("), eqp, F.lit(")"))).alias("msg"),
        format_second(created).alias("create_time"),
    )


# Carried between micro-batches: messages counted so far of a window that is still open. Without a device: the first open window.
COUNTED = "n"


def silence_step(beats: DataFrame, devices: DataFrame, seconds: int, until: int, ended: bool) -> tuple[DataFrame, DataFrame]:
    """Windows that ``until`` (epoch seconds, the watermark) has closed, of every listed device, and the counts to carry.

    ``beats`` are ``eqp_id, ts, n``: messages, or what an earlier call has
    carried. Windows start at that of the first message; when the input has
    ended they reach to that of the last one. Returns ``eqp_id, w, cnt, status``.
    """
    shift = cal.PLANT_UTC_OFFSET % seconds
    heard = beats.where("eqp_id is not null").groupBy("eqp_id", window_of(F.col("ts"), seconds).alias("w")).agg(
        F.sum(F.coalesce(COUNTED, F.lit(1))).alias("cnt"))
    bounds = beats.select(F.col("eqp_id"), F.unix_timestamp(window_of(F.col("ts"), seconds)["start"]).alias("at")).agg(
        F.min("at"), F.max(F.when(F.col("eqp_id").isNotNull(), F.col("at")))).first()
    if bounds[0] is None:
        return heard.withColumn("status", F.lit(1)), beats.limit(0)
    start = bounds[0]
    # The first window that is still open; every window before it is returned now.
    open_at = (until - shift) // seconds * seconds + shift
    if ended:
        open_at = start if bounds[1] is None else max(start, bounds[1] + seconds)
    open_at = max(start, open_at)
    closed = heard.where(F.unix_timestamp("w.start") < open_at).select("eqp_id", "w", "cnt")
    if open_at > start:
        first, last = F.timestamp_seconds(F.lit(start)), F.timestamp_seconds(F.lit(open_at - seconds))
        closed = closed.unionByName(expected_beats(devices, first, last, seconds).select(
            "eqp_id", F.struct(F.col("ts").alias("start"), F.timestamp_seconds(F.unix_timestamp("ts") + seconds).alias("end")).alias("w"),
            F.col("ok").cast("long").alias("cnt")))
    done = closed.groupBy("eqp_id", "w").agg(F.sum("cnt").cast("int").alias("cnt"))
    kept = heard.where(F.unix_timestamp("w.start") >= open_at).select("eqp_id", F.col("w.start").alias("ts"), F.col("cnt").alias(COUNTED))
    marker = beats.sparkSession.range(1).select(F.lit(None).cast("string").alias("eqp_id"), F.timestamp_seconds(F.lit(open_at)).alias("ts"),
                                                F.lit(0).cast("long").alias(COUNTED))
    return done.withColumn("status", (F.col("cnt") > 0).cast("int")), kept.unionByName(marker)


def silence_alarms(beats: DataFrame, devices: DataFrame, seconds: int, start: Column | None = None,
                   end: Column | None = None, created: Column | None = None) -> DataFrame:
    """Batch form: every listed device x window, full outer with the messages;
    real messages of a device that is not listed stay in.

    Without bounds the windows cover all time between the first and the last
    message. Messages of a faulty clock are set aside for that: one device at
    1970 or 2099 must not make windows for every device. ``clock_faults`` has
    them; the clock is ``created``.
    Messages are reduced to windows first; the bounds and the result
    both read that reduced shuffle.
    """
    if start is None or end is None:
        beats = beats.where(clock_fault(F.col("ts"), created).isNull())
    real = window_status(beats.select("eqp_id", "ts", F.lit(1).alias("ok")), seconds)
    heard = real.where("cnt > 0")
    end = heard.agg(F.max("w.start")).scalar() if end is None else end
    start = heard.agg(F.min("w.start")).scalar() if start is None else start
    expected = expected_beats(devices, start, end, seconds).select(
        "eqp_id", F.struct(F.col("ts").alias("start"),
                           F.timestamp_seconds(F.unix_timestamp("ts") + seconds).alias("end")).alias("w"),
        F.col("ok").alias("cnt"), F.col("ok").alias("status"))
    both = real.unionByName(expected).groupBy("eqp_id", "w").agg(
        F.sum("cnt").cast("int").alias("cnt"), F.max("status").cast("int").alias("status"))
    return alarms(both, created)
