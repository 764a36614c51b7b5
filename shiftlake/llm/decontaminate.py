"""Benchmark decontamination: item passages in documents, found under edits.

Words are the symbols. A passage within ``1 - similarity`` of an item's length
in edits leaves at least one of the item's blocks whole (there is one more
block than edits), so item-sized windows are laid where a block of any item
occurs, at every shift that the edits allow: no window that could match is left
out. A window and an item meet by locality-sensitive hashing: the CGK random
walk copies each word once or more as coin flips say, which turns edits into
substitutions; a key is a sample of walk outputs, and keys are repeated until
the measured recall at the edit bound reaches the target. What shares a key is
verified by exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIMILARITY = 0.8
RECALL = 0.98
SAMPLE = 3
#: Bytes of benchmark text that one pass broadcasts; a larger benchmark takes several passes.
SLICE_BYTES = 32 << 20
CHUNK_WORDS = 1 << 20
SEED_BITS = 22

MATCHES = "doc_id long, item_id long, edit_distance int, similarity double, start long"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def least_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(edits, end) of the stretch of ``region`` nearest to ``item``."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, word in enumerate(item, 1):
        best = np.empty_like(row)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (region != word), row[1:] + 1)
        row = np.minimum.accumulate(best - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


class Walks:
    """Repeated CGK walks with one sample of outputs each."""

    def __init__(self, repeats: int, seed: int = 11):
        self.repeats, self._seed = repeats, seed
        self._plans: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _plan(self, n: int):
        if n not in self._plans:
            rng = np.random.default_rng((self._seed, n))
            at = np.sort(rng.integers(0, 2 * n, (self.repeats, SAMPLE)), axis=1)
            coins = rng.integers(0, 1 << 63, (2 * n, self.repeats), dtype=np.uint64) | np.uint64(1)
            salts = rng.integers(0, 1 << 63, (self.repeats, SAMPLE), dtype=np.uint64) | np.uint64(1)
            self._plans[n] = at, coins, salts
        return self._plans[n]

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """One key per window (a row of word codes) and repeat."""
        count, n = windows.shape
        at, coins, salts = self._plan(n)
        padded = np.hstack([windows, np.zeros((count, 1), windows.dtype)]).astype(np.uint64)
        rows, place = np.arange(count)[:, None], np.zeros((count, self.repeats), np.int64)
        key = np.full((count, self.repeats), n, np.uint64)
        for step in range(2 * n):
            symbol = padded[rows, place]
            for repeat_no, k in zip(*np.nonzero(at == step)):
                mixed = (symbol[:, repeat_no] + np.uint64(k + 1)) * salts[repeat_no, k]
                key[:, repeat_no] = (key[:, repeat_no] ^ mixed ^ (mixed >> np.uint64(31))) * salts[repeat_no, 0]
            coin = (symbol + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            coin = ((coin ^ (coin >> np.uint64(32))) * coins[step]) >> np.uint64(63)
            place = np.minimum(place + coin.astype(np.int64), n)
        return key


class Benchmark:
    """Items, their blocks and their keys; ``find`` runs over documents."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float = SIMILARITY, recall: float = RECALL):
        self.codes: dict[str, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            if found := words_of(text):
                self.ids.append(item_id)
                self.items.append(np.array([self.codes.setdefault(w, len(self.codes) + 1) for w in found], np.int64))
        self.edits = [int((1 - similarity) * len(w) + 1e-9) for w in self.items]
        self._lay_blocks()
        self.walks = self._calibrated(recall)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in {len(w) for w in self.items}:
            same = [k for k, w in enumerate(self.items) if len(w) == n]
            keys = self.walks.keys(np.stack([self.items[k] for k in same])) + np.arange(self.walks.repeats, dtype=np.uint64)
            flat, owner = keys.ravel(), np.repeat(same, self.walks.repeats)
            order = np.argsort(flat, kind="stable")
            self.by_length[n] = flat[order], owner[order]

    def _lay_blocks(self):
        """Block keys by block size: sorted keys, with item and place of each."""
        rows = []
        for k, (words, edits) in enumerate(zip(self.items, self.edits)):
            bounds = np.linspace(0, len(words), edits + 2).astype(int)
            rows += [(b - a, k, a) for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
        self.blocks = []
        for size in sorted({r[0] for r in rows}):
            own = [(k, a) for n, k, a in rows if n == size]
            keys = np.concatenate([self._rolled(self.items[k][a:a + size], size) for k, a in own])
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << SEED_BITS, bool)
            seen[(keys >> np.uint64(64 - SEED_BITS)).astype(np.int64)] = True
            self.blocks.append((size, seen, keys[order], np.array(own)[order]))

    @staticmethod
    def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit key of every run of ``size`` words."""
        room = len(codes) - size + 1
        if room <= 0:
            return np.zeros(0, np.uint64)
        key = np.zeros(room, np.uint64)
        for k in range(size):
            key = (key ^ codes[k:k + room].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        return key * np.uint64(0xD6E8FEB86659FD93)

    def _calibrated(self, recall: float) -> Walks:
        """The fewest repeats that find the target share of items after as many random edits as are allowed."""
        rng = np.random.default_rng(5)
        walks = Walks(8)
        for walks in map(Walks, (8, 12, 16, 24, 32, 48, 64)):
            hits = tried = 0
            for words, edits in list(zip(self.items, self.edits))[:: max(1, len(self.items) // 64)]:
                changed = words.tolist()
                for _ in range(edits):
                    at, kind = int(rng.integers(0, len(changed) + 1)), rng.integers(0, 3)
                    fresh = -int(rng.integers(1, 1 << 20))
                    changed[at:at + (kind > 0)] = [] if kind == 2 else [fresh]
                changed = (changed + [0] * len(words))[:len(words)]
                both = walks.keys(np.stack([words, np.array(changed)]))
                hits, tried = hits + bool((both[0] == both[1]).any()), tried + 1
            if not tried or hits >= recall * tried:
                break
        return walks

    def find(self, docs: list[list[str]]) -> list[tuple[int, int, int, int]]:
        """(number of the document, item, edits, first word) of every item found in a document, at its nearest stretch."""
        gap = np.zeros(1, np.int64)
        get = self.codes.get
        parts, bounds, at = [], [], 0
        for words in docs:
            parts += [np.fromiter(map(get, words, repeat(0)), np.int64, len(words)), gap]
            bounds.append((at, at + len(words)))
            at += len(words) + 1
        line = np.concatenate(parts) if parts else gap
        starts = np.array([a for a, _ in bounds], np.int64)
        laid: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, seen, keys, own in self.blocks:
            rolled = self._rolled(line, size)
            hits = np.flatnonzero(seen[(rolled >> np.uint64(64 - SEED_BITS)).astype(np.int64)])
            low, high = (np.searchsorted(keys, rolled[hits], side) for side in ("left", "right"))
            for hit, a, b in zip(hits[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                for k, place in own[a:b].tolist():
                    laid.setdefault(len(self.items[k]), []).append((hit - place, self.edits[k]))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for n, found in laid.items():
            shifts = {s + d for s, e in found for d in range(-e, e + 1)}
            windows = np.array(sorted(s for s in shifts if -n < s < len(line)), np.int64)
            for part in np.array_split(windows, len(windows) // 8192 + 1):
                self._verify(n, part, line, starts, bounds, best)
        return [(doc, k, edits, start) for (doc, k), (edits, start) in best.items()]

    def _verify(self, n, windows, line, starts, bounds, best):
        if not len(windows):
            return
        table, owner = self.by_length[n]
        padded = np.concatenate([np.zeros(n, np.int64), line, np.zeros(n, np.int64)])
        keys = self.walks.keys(padded[(windows + n)[:, None] + np.arange(n)]) + np.arange(self.walks.repeats, dtype=np.uint64)
        low, high = (np.searchsorted(table, keys, side) for side in ("left", "right"))
        met = {(int(w), int(k)) for row, col in zip(*np.nonzero(high > low))
               for w in (windows[row],) for k in owner[low[row, col]:high[row, col]]}
        checked = set()
        for start, k in sorted(met):
            doc = max(0, int(np.searchsorted(starts, start + n // 2, "right")) - 1)
            first, last = bounds[doc]
            edits = self.edits[k]
            a, b = max(first, start - edits), min(last, start + n + edits)
            if b <= a or (doc, k, a, b) in checked:
                continue
            checked.add((doc, k, a, b))
            distance, end = least_distance(self.items[k], line[a:b])
            if distance <= edits and ((doc, k) not in best or distance < best[doc, k][0]):
                best[doc, k] = (distance, max(first, a + end - n) - first)


def benchmark_slices(benchmark: DataFrame, similarity: float, recall: float, slice_bytes: int) -> list[Benchmark]:
    """The benchmark in parts whose size is checked before they are gathered."""
    rows = benchmark.select("item_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(size // slice_bytes) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    slices = ([(r["item_id"], r["text"]) for r in rows.where(part == k).collect()] for k in range(count))
    return [Benchmark(sorted(s, key=str), similarity, recall) for s in slices]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[list[str]]]]:
    """(number of the first, words of each) for runs of documents of about CHUNK_WORDS."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(words_of(text))
        size += len(held[-1])
        if size >= CHUNK_WORDS:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
            slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edit_distance, similarity, start (word).

    The distance is that of the nearest stretch of the document. Null and empty
    texts and items match nothing. Rows that repeat a doc_id are searched one by
    one, as are items that repeat. Extra columns are not read; no rows give no rows.
    """
    found = None
    for part in benchmark_slices(benchmark, similarity, recall, slice_bytes):
        def search(batches: Iterator[pa.RecordBatch], part: Benchmark = part) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[first + doc], part.ids[k], edits, 1 - edits / len(part.items[k]), start)
                        for first, held in _chunks(batch.column(1).to_pylist()) for doc, k, edits, start in part.find(held)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64()))],
                    names=["doc_id", "item_id", "edit_distance", "similarity", "start"])

        one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, MATCHES)
        found = one if found is None else found.unionByName(one)
    return found


def contaminated(text: Column, part: Benchmark) -> Column:
    def marks(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            out = np.zeros(len(texts), bool)
            for first, held in _chunks(texts.tolist()):
                out[[first + doc for doc, *_ in part.find(held)]] = True
            yield pd.Series(out)

    return F.pandas_udf(marks, "boolean")(text)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                      slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Documents in which no item is found, with all their columns."""
    for part in benchmark_slices(benchmark, similarity, recall, slice_bytes):
        docs = docs.where(~contaminated(F.col("text"), part))
    return docs
