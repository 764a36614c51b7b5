"""Token ids in canonical, length-limited Huffman code, in blocks that decode on their own.

A written corpus is a folder with two tables. ``codebook`` has the code length
of every id that occurs; canonical codes follow from the lengths. ``blocks``
has the documents in ascending doc_id: a shard is one range of ids, a block a
run of whole documents with its bit stream and the bit offset of every
``STRIDE``-th token. Offsets let a reader decode all stretches of a block side
by side, and a lost task re-reads only its own blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlake.llm.staging import fresh_path, staged
from shiftlake.llm.tokens import EncoderHandle, default_tokenizer

STRIDE = 256
MAX_BITS = 18

RAW = "shard int, first long, doc_ids array<long>, sizes array<int>, ids binary, counts binary"
BLOCK = "shard int, first long, doc_ids array<long>, sizes array<int>, stops array<int>, bits long, stream binary"
READ = "shard int, first long, doc_id long, n_tokens long, ids binary"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError("more ids than codes of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.int64)
    level, marks = leaf, []
    for _ in range(max_bits - 1):
        even = len(level) // 2 * 2
        both = np.concatenate([leaf, level[0:even:2] + level[1:even:2]])
        rank = np.argsort(both, kind="stable")
        marks.append(rank < len(leaf))
        level = both[rank]
    need = 2 * len(leaf) - 2
    for is_leaf in reversed(marks):
        leaves = int(is_leaf[:need].sum())
        lengths[order[:leaves]] += 1
        need = 2 * (need - leaves)
    lengths[order[:need]] += 1
    return lengths


def _in_order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids in order of (length, id), how many patterns of the longest code's length begin with the code of each, that length)."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    bits = max(1, int(lengths.max(initial=1)))
    return order, np.int64(1) << (bits - lengths[order].astype(np.int64)), bits


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    order, patterns, bits = _in_order(lengths)
    codes[order] = (np.cumsum(patterns) - patterns) >> (bits - lengths[order].astype(np.int64))
    return codes


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, int, np.ndarray]:
    """(stream, its bits, bit offset of every STRIDE-th id)."""
    size = lengths[ids]
    ends = np.cumsum(size)
    start, bits = ends - size, int(ends[-1]) if len(ids) else 0
    value = codes[ids] << (64 - (start & 31) - size).astype(np.uint64)
    word, room = start >> 5, (bits >> 5) + 2
    # Codes fill disjoint bits, so sums are unions; 32-bit sums are exact in doubles.
    stream = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=room)
    stream += np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=room)
    return stream.astype(np.uint32).astype(">u4").tobytes()[:(bits + 7) // 8], bits, start[::STRIDE]


class Decoder:
    """A table over all bit patterns of the longest code's length."""

    def __init__(self, lengths: np.ndarray):
        order, patterns, self.bits = _in_order(lengths)
        # Id and code length in one number; a pattern that no code begins is the id 0 of one bit.
        self._entry = np.ones(1 << self.bits, np.int64)
        found = np.repeat(order << 5 | lengths[order].astype(np.int64), patterns)
        self._entry[:len(found)] = found

    def __call__(self, stream: bytes, stops: np.ndarray, n: int) -> np.ndarray:
        padded = stream + b"\0" * (-len(stream) % 4 + 4 * STRIDE)
        words = np.frombuffer(padded, ">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at, out = stops.astype(np.int64), np.zeros((STRIDE, len(stops)), np.int64)
        shift, mask, last = 64 - self.bits, np.uint64((1 << self.bits) - 1), len(pairs) - 1
        for step in range(min(STRIDE, n)):
            window = pairs[np.minimum(at >> 5, last)] >> (shift - (at & 31)).astype(np.uint64) & mask
            out[step] = found = self._entry[window]
            at = at + (found & 31)
        return (out.T >> 5).reshape(-1)[:n]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, block_tokens: int) -> DataFrame:
    """Raw blocks of ids: ranges of doc_id become shards, in order. The last row of a shard has only its count of every id."""
    handle = docs.sparkSession.sparkContext.broadcast(EncoderHandle(tokenizer))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, first = handle.value.get(), TaskContext.get().partitionId(), 0
        docs_held, sizes, ids, held = [], [], [], 0
        total = np.zeros(0, np.int64)

        def row(first, docs_held, sizes, ids, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([docs_held], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int32())), pa.array([ids], pa.binary()), pa.array([counts], pa.binary())],
                names=["shard", "first", "doc_ids", "sizes", "ids", "counts"])

        def block():
            nonlocal total
            line = np.concatenate(ids)
            found = np.bincount(line, minlength=len(total))
            found[:len(total)] += total
            total = found
            # Two bytes per id where they hold every id.
            return row(first, docs_held, sizes, line.astype("<u2" if len(total) <= 1 << 16 else "<u4").tobytes(), None)

        for batch in batches:
            texts = (text.as_py() for text in batch.column(1))
            for doc, found in zip(batch.column(0).to_pylist(), encode.many(texts)):
                ids.append(np.append(found, end_id))
                sizes.append(len(ids[-1]))
                docs_held.append(doc)
                held += sizes[-1]
                if held >= block_tokens:
                    yield block()
                    first, held = first + held, 0
                    docs_held, sizes, ids = [], [], []
        if sizes:
            yield block()
        if len(total):
            yield row(None, None, None, None, total.astype("<i8").tobytes())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(blocks, RAW)


def id_counts(raw: DataFrame) -> dict[int, int]:
    """Global counts; at most one row per id of the vocabulary reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0):
                found = np.frombuffer(data.as_buffer(), "<i8").copy()
                if len(found) < len(total):
                    found, total = total, found
                found[:len(total)] += total
                total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    shards = raw.where("counts IS NOT NULL").select("counts")
    found = shards.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in found.collect()}


def write_corpus(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, end_id: int = 1,
                 block_tokens: int = 1 << 17) -> str:
    """Encode ``docs`` below ``path`` and return the path.

    A null or empty text is the end id alone. Rows that repeat a doc_id stay
    next to each other; null ids come first. Extra columns are not read. No
    rows give two empty tables.
    """
    spark = docs.sparkSession
    path = path or fresh_path(spark, "corpus")
    raw = staged(tokenised(docs, tokenizer or default_tokenizer(), end_id, block_tokens), "raw-ids")
    counts = id_counts(raw)
    dense = np.zeros(max(counts, default=0) + 1, np.int64)
    for i, n in counts.items():
        dense[i] = n
    lengths = code_lengths(dense)
    rows = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(rows, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical(lengths)
        for batch in batches:
            for k, data in enumerate(batch.column("ids")):
                ids, n = data.as_buffer(), pc.sum(batch.column("sizes")[k].values).as_py()
                stream, bits, stops = encode_ids(np.frombuffer(ids, f"<u{ids.size // n}").astype(np.int64), lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(k, 1) for c in ("shard", "first", "doc_ids", "sizes")),
                     pa.array([stops], pa.list_(pa.int32())), pa.array([bits], pa.int64()), pa.array([stream], pa.binary())],
                    names=["shard", "first", "doc_ids", "sizes", "stops", "bits", "stream"])

    raw.where("ids IS NOT NULL").drop("counts").mapInArrow(encode, BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def read_corpus(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids before it in the corpus), n_tokens and its ids.

    With ``digest_only`` the ids are replaced by their crc32 as soon as a block is decoded.
    """
    lengths = np.zeros(1, np.int64)
    book = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()
    if book:
        lengths = np.zeros(max(r["id"] for r in book) + 1, np.int64)
        for r in book:
            lengths[r["id"]] = r["bits"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first, docs, sizes, stops, stream = (
                    batch.column(c)[row] for c in ("shard", "first", "doc_ids", "sizes", "stops", "stream"))
                size = np.array(sizes.values, np.int64)
                ends = np.cumsum(size)
                ids = decoder(stream.as_py(), np.array(stops.values), int(ends[-1])).astype("<u4")
                parts = [ids[end - n:end].tobytes() for n, end in zip(size.tolist(), ends.tolist())]
                last = pa.array(map(zlib.crc32, parts), pa.int64()) if digest_only else pa.array(parts, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()] * len(size), pa.int32()), pa.array(first.as_py() + ends - size),
                     docs.values, pa.array(size), last],
                    names=["shard", "first", "doc_id", "n_tokens", "ids_crc32" if digest_only else "ids"])

    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    found = blocks.mapInArrow(decode, READ.replace("ids binary", "ids_crc32 long") if digest_only else READ)
    total = blocks.groupBy("shard").agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    # One row per shard, so the running total is a short list however long the corpus is.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    base = total.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(base, "shard").withColumn("start", F.col("base") + F.col("first")).drop("shard", "first", "base")
