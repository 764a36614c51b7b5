"""Keyed state processor: sequences with timers."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.sequences import Pattern

# Send the processors with the query, so that the package need not be installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

SEQUENCE_OUT = "key string, seq bigint, outcome string, matched int, last_seq bigint"


class SequenceFinder(StatefulProcessor):
    """Finds step sequences per key in event-time order.

    Rows wait until the watermark passes them, so that late neighbours are in
    place; a second timer at the end of the span reports a start that nothing
    followed.
    """

    def __init__(self, steps: int, span_ms: int):
        self._steps, self._span_ms = steps, span_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", "seq bigint, at bigint, flags int")
        self._live = handle.getListState("live", "seq bigint, at bigint, matched int, last_seq bigint")
        self._wake = handle.getValueState("wake", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            self._rows.appendList([(int(s), int(a), int(f)) for s, a, f in zip(chunk["seq"], chunk["at"], chunk["flags"])])
            self._wake_at(int(chunk["at"].min()))
        return iter(())

    def _wake_at(self, at: int) -> None:
        """Keep a single timer for waiting rows, at the earliest of them."""
        if self._wake.exists():
            planned = self._wake.get()[0]
            if planned <= at:
                return
            self._handle.deleteTimer(planned)
        self._handle.registerTimer(at)
        self._wake.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        waiting = sorted((r for r in self._rows.get()), key=lambda r: (r[1], r[0])) if self._rows.exists() else []
        due = [r for r in waiting if r[1] <= mark]
        rest = [tuple(r) for r in waiting if r[1] > mark]
        live = [tuple(r) for r in self._live.get()] if self._live.exists() else []
        out = []
        for seq, at, flags in due:
            going = []
            for start, began, matched, last in live:
                if at - began >= self._span_ms:
                    out.append((key[0], start, "timeout", matched, last))
                elif flags >> matched & 1:
                    if matched + 1 == self._steps:
                        out.append((key[0], start, "match", self._steps, seq))
                    else:
                        going.append((start, began, matched + 1, seq))
            if flags & 1:
                going.append((seq, at, 1, seq))
                self._handle.registerTimer(int(at) + self._span_ms)
            live = going
        out += [(key[0], s, "timeout", m, last) for s, began, m, last in live if mark - began >= self._span_ms]
        live = [r for r in live if mark - r[1] < self._span_ms]
        if self._wake.exists() and self._wake.get()[0] <= mark:
            self._wake.clear()
        if rest:
            self._rows.put(rest)
            self._wake_at(min(r[1] for r in rest))
        else:
            self._rows.clear()
        self._live.put(live) if live else self._live.clear()
        if out:
            yield pd.DataFrame(out, columns=["key", "seq", "outcome", "matched", "last_seq"])

    def close(self) -> None:
        pass


def find_sequences(stream: DataFrame, pattern: Pattern, key: str, delay: str = "1 minute") -> DataFrame:
    """Stream with ``ts``, ``seq`` and ``key`` -> outcome of every first step."""
    flags = F.lit(0)
    for i, predicate in enumerate(pattern.predicates):
        flags = flags + F.coalesce(F.expr(predicate), F.lit(False)).cast("int") * (1 << i)
    rows = stream.withWatermark("ts", delay).select(
        F.col(key).cast("string").alias("key"), "seq", "ts", F.unix_millis("ts").alias("at"), flags.alias("flags"))
    return rows.groupBy("key").transformWithStateInPandas(
        SequenceFinder(len(pattern.predicates), pattern.within_seconds * 1000), SEQUENCE_OUT, "append", "EventTime")
