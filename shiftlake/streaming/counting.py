"""Running counters per key in map state, each entry with a time to live of its own.

In processing time the state store itself forgets an entry so long after its
last write. In event time a row waits until the watermark has passed its minute,
so that late neighbours are counted in order; an entry is over once a row lies
a time to live behind its last write, and a timer frees what no row comes for.
The same input then gives the same alarms however it is cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.counters import THRESHOLD

EVENT_TIME, PROCESSING_TIME = "EventTime", "ProcessingTime"
TTL_SECONDS = 2 * 3600
BUCKET_MS = 60_000


class TtlCounters(StatefulProcessor):
    """Returns the rows at which a counter reaches the threshold, with all counters of the key.

    Input per key: ``seq, at`` (milliseconds), ``hits`` (what the row adds to
    each counter) and ``payload`` (text returned with the row).
    """

    def __init__(self, size: int, threshold: int, ttl_ms: int, mode: str):
        self._size, self._threshold, self._ttl_ms, self._in_event_time = size, threshold, ttl_ms, mode == EVENT_TIME

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        if self._in_event_time:
            self._counts = handle.getMapState("counts", "counter int", "n bigint, at bigint")
            # Rows wait by the minute: a timer reads the minutes that are due and no others.
            self._wake = handle.getValueState("wake", "at bigint")
            self._waiting = handle.getMapState(
                "waiting", "bucket bigint", "rows array<struct<seq:bigint,at:bigint,hits:array<int>,payload:string>>")
        else:
            self._counts = handle.getMapState("counts", "counter int", "n bigint, at bigint", self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        buckets: dict[int, list[tuple]] = {}
        for chunk in rows:
            for seq, at, hits, payload in zip(chunk["seq"], chunk["at"], chunk["hits"], chunk["payload"]):
                row = (int(seq), int(at), [int(h) for h in hits], payload)
                buckets.setdefault(row[1] // BUCKET_MS if self._in_event_time else 0, []).append(row)
        if not self._in_event_time:
            yield from self._count(key, buckets[0])
            return
        held = {int(b[0]) for b in self._waiting.keys()}
        for bucket, fresh in buckets.items():
            if bucket in held:
                fresh = self._rows_of(self._waiting.getValue((bucket,))) + fresh
            self._waiting.updateValue((bucket,), (fresh,))
        self._wake_after(min(buckets))

    @staticmethod
    def _rows_of(value) -> list[tuple]:
        return [(r[0], r[1], list(r[2]), r[3]) for r in value[0]]

    def _wake_after(self, bucket: int) -> None:
        """A key has one timer for waiting rows, at the end of their first minute."""
        end = (bucket + 1) * BUCKET_MS
        if self._wake.exists():
            planned = int(self._wake.get()[0])
            if planned <= end:
                return
            self._handle.deleteTimer(planned)
        self._handle.registerTimer(end)
        self._wake.update((end,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        if self._wake.exists() and int(self._wake.get()[0]) <= mark:
            self._wake.clear()
            ready, rest = [], []
            for bucket in sorted(int(b[0]) for b in self._waiting.keys()):
                (ready if (bucket + 1) * BUCKET_MS <= mark else rest).append(bucket)
            rows: list[tuple] = []
            for bucket in ready:
                rows += self._rows_of(self._waiting.getValue((bucket,)))
                self._waiting.removeKey((bucket,))
            if rest:
                self._wake_after(rest[0])
            if rows:
                yield from self._count(key, rows)
        # A row that still waits lies past the mark, so what is over at the mark is over for it.
        for counter, (_, at) in self._held().items():
            if at + self._ttl_ms <= mark:
                self._counts.removeKey((counter,))

    def _held(self) -> dict[int, tuple[int, int]]:
        return {int(c[0]): (int(v[0]), int(v[1])) for c, v in self._counts.iterator()}

    def _count(self, key, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        held, written, out = self._held(), set(), []
        for seq, at, hits, payload in sorted(rows, key=lambda r: (r[1], r[0])):
            fired = False
            for counter, hit in enumerate(hits):
                n, last = held.get(counter, (0, at))
                if self._in_event_time and at - last >= self._ttl_ms:
                    n = 0
                    held.pop(counter, None)
                if hit:
                    held[counter] = (n + hit, at)
                    written.add(counter)
                    fired = fired or n < self._threshold <= n + hit
            if fired:
                out.append((*key, seq, payload, [held.get(c, (0, 0))[0] for c in range(self._size)]))
        for counter in written:
            # What was written and is over again before the last row is not kept.
            if counter in held:
                self._counts.updateValue((counter,), held[counter])
            else:
                self._counts.removeKey((counter,))
        if self._in_event_time and held:
            # Frees these entries if no row does; a later write has a later timer.
            self._handle.registerTimer(max(at for _, at in held.values()) + self._ttl_ms)
        if out:
            yield pd.DataFrame(out, columns=["key", "seq", "payload", "counts"])

    def close(self) -> None:
        pass


def ttl_counters(stream: DataFrame, key: str, adds: Sequence[tuple[str, Column]], kept: Sequence[str], threshold: int = THRESHOLD,
                 ttl_seconds: int = TTL_SECONDS, mode: str = EVENT_TIME, delay: str = "1 minute") -> DataFrame:
    """Rows of ``stream`` (``ts``, ``seq``, ``key``) at which a counter reaches the threshold: key, seq, ``kept`` and all counters.

    ``adds`` names each counter and what a row adds to it. A counter starts
    again once its last write is ``ttl_seconds`` old. Rows without ``ts`` or
    ``key`` and rows behind the watermark are dropped.
    """
    rows = stream.where(F.col("ts").isNotNull() & F.col(key).isNotNull())
    if mode == EVENT_TIME:
        rows = rows.withWatermark("ts", delay)
    hits = F.array(*[F.coalesce(c, F.lit(0)).cast("int") for _, c in adds])
    fields = F.struct(*[F.col(c).cast("string").alias(c) for c in kept])
    rows = rows.select(F.col(key).cast("string").alias("key"), "seq", *(["ts"] if mode == EVENT_TIME else []),
                       F.unix_millis("ts").alias("at"), hits.alias("hits"), F.to_json(fields).alias("payload"))
    found = rows.groupBy("key").transformWithStateInPandas(
        TtlCounters(len(adds), threshold, ttl_seconds * 1000, mode), "key string, seq bigint, payload string, counts array<bigint>", "append", mode)
    parsed = F.from_json("payload", ", ".join(f"`{c}` string" for c in kept))
    return found.select(F.col("key").alias(key), "seq", *[parsed[c].alias(c) for c in kept],
                        *[F.col("counts")[i].alias(n) for i, (n, _) in enumerate(adds)])
