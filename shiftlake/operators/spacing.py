"""Greedy spacing: the first moment of a key counts, then the next one at least a gap later."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Send the function with the query, so that the package need not be installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _changes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Where a row's key differs from the row before; the first row is left to the caller."""
    new = np.zeros(batch.num_rows, bool)
    for name in names:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _starts(secs: np.ndarray, free: np.ndarray, last: int | None, reach: int) -> np.ndarray:
    """Starts among the sorted seconds of one key, where ``last`` is the start in force before them."""
    mask = free.copy()
    heads = np.flatnonzero(free)
    # Only where a span is followed by seconds that are not free is there a chain to walk.
    spans = list(zip(heads, np.append(heads[1:], len(secs))))
    if last is not None and (not len(heads) or heads[0] > 0):
        spans.insert(0, (-1, heads[0] if len(heads) else len(secs)))
    for head, end in spans:
        if end - head < 2:
            continue
        at, began = head, last if head < 0 else secs[head]
        while (at := at + 1 + int(np.searchsorted(secs[at + 1:end], began + reach))) < end:
            mask[at], began = True, secs[at]
    return mask


def spaced_starts(seconds: DataFrame, keys: Sequence[str], sec: str, gap: int, strict: bool = False,
                  reset: Column | None = None) -> DataFrame:
    """Rows ``keys, sec`` that start a new span.

    ``seconds`` holds one row per key and whole second. A span begins at the
    first second, at every second where ``reset`` holds, and at the first
    second ``gap`` or more (``strict``: more than ``gap``) after the start of
    the span before. Seconds that far from their predecessor, and resets,
    start a span whatever came before. The rest is decided in one pass over
    the sorted seconds that holds no more than the last start of a key, so a
    key that is never silent needs no more memory than any other.
    """
    reach = gap + 1 if strict else gap
    whole = Window.partitionBy(*keys).orderBy(sec)
    free = F.coalesce(F.col(sec) - F.lag(sec).over(whole) >= reach, F.lit(True))
    if reset is not None:
        free = free | F.coalesce(reset, F.lit(False))
    marked = seconds.select(*keys, sec, free.alias("_free"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            secs = batch.column(sec).to_numpy(zero_copy_only=False).astype(np.int64)
            free = batch.column("_free").to_numpy(zero_copy_only=False)
            mask = np.zeros(batch.num_rows, bool)
            cuts = [0, *np.flatnonzero(_changes(batch, keys)).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                own = tuple(batch.column(k)[a].as_py() for k in keys)
                if own != key:
                    key, last = own, None
                mask[a:b] = _starts(secs[a:b], free[a:b], last, reach)
                hits = np.flatnonzero(mask[a:b])
                if len(hits):
                    last = int(secs[a + hits[-1]])
            yield batch.filter(pa.array(mask)).select([*keys, sec])

    # The window has left the rows of a key together and in order.
    return marked.sortWithinPartitions(*keys, sec).mapInArrow(walk, marked.drop("_free").schema)
