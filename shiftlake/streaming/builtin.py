"""Streaming forms that Spark's own operators express."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..operators.heartbeat import window_status


def window_alarms(beats: DataFrame, expected: DataFrame | None, seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Window results per device, returned once the watermark has passed the window.

    ``beats`` and ``expected`` carry ``eqp_id, ts, ok``; expected devices may
    come from a stream of their own.
    """
    rows = beats.select("eqp_id", "ts", "ok").withWatermark("ts", delay)
    if expected is not None:
        rows = rows.unionByName(expected.select("eqp_id", "ts", "ok").withWatermark("ts", delay))
    return window_status(rows, seconds)


def first_per_key(stream: DataFrame, keys: Sequence[str], ttl: str = "2 hours") -> DataFrame:
    """First record per key; the key is forgotten ``ttl`` after the record that was kept."""
    return stream.withWatermark("ts", ttl).dropDuplicatesWithinWatermark(list(keys))


def route(batch: DataFrame, conditions: dict[str, Column]) -> dict[str, DataFrame]:
    """Side outputs of a micro-batch: one filtered frame per name."""
    return {name: batch.where(condition) for name, condition in conditions.items()}
