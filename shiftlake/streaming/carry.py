"""Ordered operators over micro-batches, with the unfinished rows carried along.

A micro-batch is joined by the rows carried from the batch before. Rows up to
the watermark are settled: the batch operator runs on them, sliced and safe
for hot keys as in batch. What it cannot finish yet (one row per key, or the
lines of open brackets) and the rows past the watermark are written to the
carry folder under the batch id. A replayed batch finds the same carried rows
and overwrites the same outputs.

Rows older than the watermark cannot be settled any more; they are written
below ``late`` of the carry folder. Rows far ahead of the clock would push the
watermark past everything that follows; they are written below ``ahead`` and
do not count. ``flush`` settles what is carried when the input has ended.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..operators import brackets, counters, dedup, heartbeat, intervals
from ..operators.dedup import latest_per_key
from ..sinks.files import ControlFiles
from ..sources.tables import Refreshing
from .options import StreamOptions

# (settled rows, watermark, whether the input has ended) -> (finished results, rows to carry)
Step = Callable[[DataFrame, Column, bool], tuple[DataFrame, DataFrame]]
Sink = Callable[[DataFrame, int], None]

# How far a time may lie ahead of the clock; plant clocks drift by minutes, not days.
AHEAD_SECONDS = 86_400
# First moment of a run that a shift switch has cut.
ORIGIN = "_origin"

# Marks the carried record of a key that has been returned.
KEPT = "_kept"

# Only the batch before is needed for a replay; some more help to look into a failure.
BATCHES_KEPT = 10


class Carry:
    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._marks = ControlFiles(spark, f"{self._folder}/marks", "batch")

    def load(self, batch_id: int) -> tuple[DataFrame | None, int | None]:
        """Rows and watermark (microseconds) left by the batch before ``batch_id``."""
        earlier = [n for n in self._marks.numbers() if n < batch_id]
        if not earlier:
            return None, None
        return (self._spark.read.parquet(f"{self._folder}/rows/{earlier[-1]}"),
                self._marks.read(earlier[-1])["watermark"])

    def next_batch(self) -> int:
        return max(self._marks.numbers(), default=-1) + 1

    def save(self, batch_id: int, rows: DataFrame, watermark: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self._folder}/rows/{batch_id}")
        self._marks.write(batch_id, {"watermark": watermark}, overwrite=True)
        for old in self._marks.numbers()[:-BATCHES_KEPT]:
            self._marks.remove(old)
            self._marks.remove_folder(f"{self._folder}/rows/{old}")


def _set_aside(rows: DataFrame, folder: str, batch_id: int) -> None:
    if not rows.isEmpty():
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def run_ordered(stream: DataFrame, step: Step, sink: Sink, carry_folder: str, options: StreamOptions,
                delay_seconds: int, ahead_seconds: int = AHEAD_SECONDS,
                clock: Callable[[], float] = time.time) -> DataStreamWriter:
    """Stream of rows with ``ts`` through ``step``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        carry = Carry(batch.sparkSession, carry_folder)
        held, mark = carry.load(batch_id)
        at = F.unix_micros("ts")
        limit = int((clock() + ahead_seconds) * 1_000_000)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _set_aside(batch.where(at > limit), f"{carry_folder}/ahead", batch_id)
            fresh = batch.where(at <= limit)
            if mark is not None:
                _set_aside(fresh.where(at <= mark), f"{carry_folder}/late", batch_id)
                fresh = fresh.where(at > mark)
            newest = fresh.agg(F.max(at)).first()[0]
            if newest is None and held is None:
                return
            reached = [m for m in (mark, None if newest is None else newest - delay_seconds * 1_000_000) if m is not None]
            mark = max(reached)
            rows = fresh if held is None else held.unionByName(fresh, allowMissingColumns=True)
            passed = at <= mark
            done, keep = step(rows.where(passed), F.timestamp_micros(F.lit(mark)), False)
            sink(done, batch_id)
            carry.save(batch_id, keep.unionByName(rows.where(~passed), allowMissingColumns=True), mark)
        finally:
            batch.unpersist()

    return options.apply(stream).foreachBatch(each)


def set_aside(spark: SparkSession, carry_folder: str, schema: StructType) -> DataFrame:
    """The rows that no result has, with the ``reason`` (late, ahead) and the ``batch`` that brought them."""
    marks = ControlFiles(spark, f"{carry_folder}/marks", "batch")
    out = None
    for reason in ("late", "ahead"):
        folder = f"{carry_folder}/{reason}"
        found = [n for n in marks.children(folder) if n.startswith("batch=")]
        rows = spark.read.parquet(folder) if found else spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
        rows = rows.select(*schema.fieldNames(), "batch", F.lit(reason).alias("reason"))
        out = rows if out is None else out.unionByName(rows)
    return out


def flush(spark: SparkSession, step: Step, sink: Sink, carry_folder: str) -> None:
    """Settle the carried rows of an input that has ended, as one more batch.

    A second call finds nothing carried and writes nothing; rows that arrive
    later are late.
    """
    carry = Carry(spark, carry_folder)
    batch_id = carry.next_batch()
    held, mark = carry.load(batch_id)
    if held is None or held.isEmpty():
        return
    mark = max(mark, held.agg(F.max(F.unix_micros("ts"))).first()[0])
    done, keep = step(held, F.timestamp_micros(F.lit(mark)), True)
    sink(done, batch_id)
    carry.save(batch_id, keep.limit(0), mark)


def parquet_sink(folder: str) -> Sink:
    """One folder per batch, overwritten on replay."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def step_interval_step(keys: Sequence[str] = ("eqpid", "tubeid")) -> Step:
    return lambda rows, mark, ended: (intervals.step_intervals(rows, keys), intervals.open_runs(rows, keys))


def shift_interval_step(keys: Sequence[str] = ("eqpid", "tubeid")) -> Step:
    """Cuts are returned as soon as the watermark passes the shift switch. A run that was cut is carried from the
    switch on, with its first moment beside it."""
    def step(rows: DataFrame, mark: Column, ended: bool) -> tuple[DataFrame, DataFrame]:
        if ORIGIN not in rows.columns:
            rows = rows.withColumn(ORIGIN, F.lit(None).cast("timestamp"))
        done = intervals.step_intervals_by_shift(rows, keys, open_until=mark)
        done = done.withColumn("orig_start", F.coalesce(ORIGIN, "orig_start")).drop(ORIGIN)
        first = F.coalesce(ORIGIN, "_began")
        kept = intervals.open_runs(rows.withColumn("_began", F.col("ts")), keys, cut_until=mark)
        return done, kept.withColumn(ORIGIN, F.when(first < F.col("ts"), first)).drop("_began")

    return step


def record_interval_step(keys: Sequence[str], terminal: Column | None = None) -> Step:
    return lambda rows, mark, ended: (intervals.record_intervals(rows, keys, terminal), latest_per_key(rows, keys))


def defect_step(keys: Sequence[str] = ("boat_id",), threshold: int = counters.THRESHOLD) -> Step:
    """Running defect counters: one row per key carries its counts. They are never forgotten; see ``counting`` for a time to live."""
    def step(rows: DataFrame, mark: Column, ended: bool) -> tuple[DataFrame, DataFrame]:
        if counters.CARRIED not in rows.columns:
            rows = rows.withColumn(counters.CARRIED, F.lit(None).cast("array<bigint>"))
        done = counters.defect_threshold(rows, keys, threshold).drop(counters.CARRIED)
        return done, counters.carried_counts(rows, keys)

    return step


def silence_window_step(devices: Refreshing, seconds: int) -> Step:
    """Windows of every listed device, closed as the watermark moves. The list is read again by its own age.

    A window is judged by the list of the batch that closes it.
    """
    def step(rows: DataFrame, mark: Column, ended: bool) -> tuple[DataFrame, DataFrame]:
        if heartbeat.COUNTED not in rows.columns:
            rows = rows.withColumn(heartbeat.COUNTED, F.lit(None).cast("long"))
        until = rows.sparkSession.range(1).select(F.unix_timestamp(mark)).first()[0]
        return heartbeat.silence_step(rows.select("eqp_id", "ts", heartbeat.COUNTED), devices.get(), seconds, until, ended)

    return step


def dedup_step(keys: Sequence[str], ttl_seconds: int = 7200) -> Step:
    """First record per key in event time, and again once the kept one is ``ttl_seconds`` old.

    The kept record of a key is carried until it is that old.
    """
    def step(rows: DataFrame, mark: Column, ended: bool) -> tuple[DataFrame, DataFrame]:
        if KEPT not in rows.columns:
            rows = rows.withColumn(KEPT, F.lit(None).cast("boolean"))
        found = dedup.first_within_ttl(rows, keys, ttl_seconds)
        young = F.unix_timestamp("ts") + ttl_seconds > F.unix_timestamp(mark)
        kept = latest_per_key(found, keys).where(young).withColumn(KEPT, F.lit(True))
        return found.where(F.col(KEPT).isNull()).drop(KEPT), kept.select(*rows.columns)

    return step


def bracket_step(keys: Sequence[str] = ("host", "path"), timeout: int = brackets.TIMEOUT_SECONDS) -> Step:
    """Brackets closed or timed out by the watermark; the lines of the others are carried."""
    def step(rows: DataFrame, mark: Column, ended: bool) -> tuple[DataFrame, DataFrame]:
        found = brackets.bracket_lines(rows, keys, timeout=timeout)
        still_open = F.lit(not ended) & (F.col("kind") == "miss_end") & (F.unix_timestamp("begin_ts") + timeout > F.unix_timestamp(mark))
        kept = found.where(still_open).select(*keys, F.explode("lines").alias("_l")).select(
            *keys, F.timestamp_seconds("_l.sec").alias("ts"), F.col("_l.seq").alias("seq"), F.col("_l.line").alias("line"))
        return brackets.as_texts(found.where(~still_open)), kept.select(*rows.columns)

    return step
