"""Best-fit packing of token pieces into sequences, by exact complements first.

Only the number of pieces of each length matters to the plan, so the plan is
made on a table of at most ``max_tokens`` counts, whatever the corpus holds.
Pieces then find their places by rank: a piece is the r-th of its length, and
the plan gives every range of ranks a range of sequences. Ranks come from
counts per written part and length, never from sorting a length in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlake.llm.staging import staged
from shiftlake.llm.tokens import EncoderHandle, default_tokenizer

PIECES = "shard int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids; ``nth`` counts pieces of a length within the task's part."""
    handle = docs.sparkSession.sparkContext.broadcast(EncoderHandle(tokenizer))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, seen = handle.value.get(), TaskContext.get().partitionId(), {}
        schema = pa.schema([("shard", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
                            ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
        rows, held = [], 0
        for batch in batches:
            texts = (text.as_py() for text in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encode.many(texts)):
                ids = np.append(ids, end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), max_tokens)):
                    part = ids[start:start + max_tokens]
                    data = part.tobytes()
                    nth = seen.get(len(part), 0)
                    seen[len(part)] = nth + 1
                    rows.append((shard, nth, doc, piece, start, len(part), zlib.crc32(data), data))
                    held += len(data)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(pieces, PIECES)


class _Stock:
    """Pieces left of each length, with pointers into the pair and triple sums.

    Stock only shrinks, so a pointer that has passed a combination never needs
    to return to it: all searches together cost O(size ** 2).
    """

    def __init__(self, counts: dict[int, int], size: int):
        self.size = size
        self.left = [counts.get(n, 0) for n in range(size + 1)]
        self._pair = [s - 1 for s in range(size + 1)]
        self._triple = [s - 2 for s in range(size + 1)]

    def times(self, items: tuple[int, ...]) -> int:
        """How often the combination can be taken."""
        return min(self.left[n] // items.count(n) for n in set(items))

    def pair(self, total: int) -> tuple[int, int] | None:
        left, a = self.left, self._pair[total]
        while 2 * a >= total and a > 0:
            b = total - a
            if left[a] and left[b] and (a != b or left[a] > 1):
                break
            a -= 1
        self._pair[total] = a
        return (a, total - a) if 2 * a >= total and a > 0 else None

    def complement(self, length: int) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap beside ``length`` exactly."""
        gap = self.size - length
        if gap and self.left[gap] and self.times((length, gap)):
            return (gap,)
        found = self.pair(gap) if gap > 1 else None
        if found and self.times((length, *found)):
            return found
        while gap > 2 and self._triple[gap] > 0:
            a = self._triple[gap]
            found = self.pair(gap - a) if self.left[a] and gap - a > 1 else None
            if found and self.times((length, a, *found)):
                return (a, *found)
            self._triple[gap] = a - 1
        return None

    def take(self, items: tuple[int, ...], times: int):
        for n in items:
            self.left[n] -= times


def plan(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences): exact fills, then best fit of the rest, longest first."""
    stock, made = _Stock(counts, size), []
    for length in range(size, 0, -1):
        if length == size and stock.left[size]:
            made.append(((size,), stock.left[size]))
            stock.left[size] = 0
        while stock.left[length] and (rest := stock.complement(length)):
            items = (length, *rest)
            times = stock.times(items)
            stock.take(items, times)
            made.append((items, times))
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(size, 0, -1):
        while todo := stock.left[length]:
            room = min((r for r in open_at if r >= length), default=None)
            if room is None:
                each = min(todo, size // length)
                items, times = (length,) * each, todo // each
                stock.left[length] -= each * times
                open_at.setdefault(size - length * each, []).append((items, times))
                continue
            items, times = open_at[room].pop()
            if not open_at[room]:
                del open_at[room]
            put = min(times, todo)
            if put < times:
                open_at.setdefault(room, []).append((items, times - put))
            open_at.setdefault(room - length, []).append(((*items, length), put))
            stock.left[length] -= put
    return made + [entry for entries in open_at.values() for entry in entries]


def slots(made: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of every place in the plan."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for items, times in made:
        offset = 0
        for n in items:
            first = used.get(n, 0)
            used[n] = first + times
            out.append((n, first, first + times, sequence, offset))
            offset += n
        sequence += times
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, max_tokens: int = 2048) -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, placements).

    A null or empty text is the end id alone. Rows that repeat a doc_id are
    packed one by one; a null doc_id stays null. Extra columns are not read; no
    rows give no rows. The plan is broadcast: it has at most a few ranges for
    each of the ``max_tokens`` lengths.
    """
    spark = docs.sparkSession
    pieces = staged(cut(docs, tokenizer or default_tokenizer(), end_id, max_tokens), "pieces")
    counted = pieces.groupBy("shard", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    base = counted.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        slots(plan(counts, max_tokens)), "place_length long, first long, last long, sequence long, offset long")
    rank = F.col("base") + F.col("nth")
    placed = pieces.drop("ids").join(base, ["shard", "length"]).join(
        F.broadcast(places),
        (F.col("length") == F.col("place_length")) & (rank >= F.col("first")) & (rank < F.col("last")))
    return pieces, placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + rank - F.col("first")).alias("sequence_id"), "offset", "shard", "nth")


def sequences(pieces: DataFrame, placements: DataFrame) -> DataFrame:
    """sequence_id and its ids (little-endian unsigned 32-bit): at most ``max_tokens`` pieces meet in a row."""
    parts = placements.join(pieces.select("shard", "nth", "length", "ids"), ["shard", "nth", "length"])
    return parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.concat(F.lit(b""), F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))).alias("ids"))
