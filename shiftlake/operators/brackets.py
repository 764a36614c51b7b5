"""Begin/end log lines merged into one text, with the incomplete ones told apart.

Rules, per key in time order: a start line opens; while open every line is
kept; an end line not later than ``start + timeout`` closes and yields
``merged``. An open bracket that is not closed in time yields ``miss_end``; an
end line outside a bracket yields ``miss_begin``; other lines outside are
dropped. A second start while open is an ordinary line.

Whether a start line opens depends on the brackets before it, which is the
only sequential part. It is decided on one summary row per key and second
(log times have whole seconds); the lines themselves are then placed by
windows over a single second, so no task has to hold the lines of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import once
from ..functions.text import contains_ignoring_case, not_blank, strip
from .spacing import spaced_starts

# Markers and times of the furnace log.
START_MARK = "recipe start recipe:"
END_MARK = "recipe end recipe:"
TIMEOUT_SECONDS = 120
LOG_TIME_FORMAT = "MM/dd/yyyy HH:mm:ss"


def parse_log_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Shipped log lines -> ``host, path, line, ts``; a line without a time has a null ``ts``."""
    shape = "struct<host:struct<name:string>,log:struct<file:struct<path:string>>,message:string>"
    rows = once(df.where(not_blank(F.col(value))), _l=F.from_json(value, shape))
    message = F.col("_l.message")
    return once(
        rows,
        host=F.col("_l.host.name"),
        path=F.col("_l.log.file.path"),
        line=strip(message),
        ts=F.try_to_timestamp(F.substring(message, 1, 19), F.lit(LOG_TIME_FORMAT)),
    ).drop(value, "_l")


def merge_brackets(df: DataFrame, keys: Sequence[str] = ("host", "path"), line: str = "line",
                   timeout: int = TIMEOUT_SECONDS, start_mark: str = START_MARK,
                   end_mark: str = END_MARK) -> DataFrame:
    """Rows ``ts, seq, line`` -> ``keys, kind, begin_ts, end_ts, n_lines, text``."""
    return as_texts(bracket_lines(df, keys, line, timeout, start_mark, end_mark))


def as_texts(found: DataFrame) -> DataFrame:
    text = F.array_join(F.transform("lines", lambda x: x["line"]), " ")
    return found.select("*", F.size("lines").cast("long").alias("n_lines"), text.alias("text")).drop("lines")


def bracket_lines(df: DataFrame, keys: Sequence[str], line: str = "line", timeout: int = TIMEOUT_SECONDS,
                  start_mark: str = START_MARK, end_mark: str = END_MARK) -> DataFrame:
    """As ``merge_brackets``, with the lines of each bracket as structs ``sec, seq, line``."""
    is_start = contains_ignoring_case(F.col(line), start_mark)
    is_end = contains_ignoring_case(F.col(line), end_mark) & ~is_start
    lines = df.select(
        *keys, F.unix_timestamp("ts").alias("sec"), "seq", F.col(line).alias("line"),
        is_start.cast("int").alias("s"), is_end.cast("int").alias("e"))

    # One row per second: any end line, number of end lines, and whether a
    # start line outlives the second (comes after its last end line).
    last_start = F.max(F.when(F.col("s") == 1, F.col("seq")))
    last_end = F.max(F.when(F.col("e") == 1, F.col("seq")))
    seconds = lines.groupBy(*keys, "sec").agg(
        F.sum("e").alias("ends"),
        (last_start.isNotNull() & (last_end.isNull() | (last_start > last_end))).alias("outlives"))

    by_time = Window.partitionBy(*keys).orderBy("sec")
    past = by_time.rowsBetween(Window.unboundedPreceding, -1)
    marked = seconds.withColumn("end_at", F.last(F.when(F.col("ends") > 0, F.col("sec")), True).over(
        by_time.rowsBetween(Window.unboundedPreceding, 0)))
    alive = marked.where("outlives").select(
        *keys, "sec", (F.coalesce(F.col("end_at") != F.lag("end_at").over(by_time),
                                  F.col("end_at").isNotNull() & F.lag("end_at").over(by_time).isNull())
                       ).alias("after_end"))
    openers = spaced_starts(alive, keys, "sec", timeout, strict=True, reset=F.col("after_end"))
    openers = openers.withColumn("opens", F.lit(True))

    # The bracket a second begins in: the last opener before it, unless it was
    # ended in between or is too old.
    states = marked.join(openers, [*keys, "sec"], "left").select(
        "*",
        F.last(F.when(F.col("opens"), F.struct("sec", "ends")), True).over(past).alias("opener"),
        F.lag("end_at").over(by_time).alias("ended"))
    running = (F.col("opener").isNotNull()
               & (F.col("ended").isNull() | (F.col("ended") <= F.col("opener.sec")))
               & (F.col("sec") - F.col("opener.sec") <= timeout))
    states = states.select(*keys, "sec", F.when(running, F.col("opener")).alias("inherited"))

    # Place the lines. Within a second an end line separates brackets; a
    # bracket is named by its opening second and the end lines before it there.
    within = Window.partitionBy(*keys, "sec").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("e").over(within) - F.col("e")
    placed = lines.join(states, [*keys, "sec"]).withColumn("_part", before)
    in_part = Window.partitionBy(*keys, "sec", "_part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    opened_here = F.max("s").over(in_part) == 1
    inherited = (F.col("_part") == 0) & F.col("inherited").isNotNull()
    named = placed.withColumn(
        "bracket",
        F.when(inherited, F.struct(F.col("inherited.sec").alias("sec"), F.col("inherited.ends").alias("part")))
        .when(opened_here, F.struct(F.col("sec"), F.col("_part").alias("part"))))

    orphans = named.where("bracket is null and e = 1").select(
        *keys, F.lit("miss_begin").alias("kind"),
        F.timestamp_seconds("sec").alias("begin_ts"), F.timestamp_seconds("sec").alias("end_ts"),
        F.array(F.struct("sec", "seq", "line")).alias("lines"))
    # A bracket lasts at most the timeout, so its lines fit one text.
    texts = named.where("bracket is not null").groupBy(*keys, "bracket").agg(
        F.when(F.max("e") == 1, F.lit("merged")).otherwise(F.lit("miss_end")).alias("kind"),
        F.timestamp_seconds(F.min("sec")).alias("begin_ts"),
        F.timestamp_seconds(F.max("sec")).alias("end_ts"),
        F.sort_array(F.collect_list(F.struct("sec", "seq", "line"))).alias("lines"))
    return texts.drop("bracket").unionByName(orphans)
