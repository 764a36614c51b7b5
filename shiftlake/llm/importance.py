"""Importance resampling towards a target: documents are drawn by how much likelier the target makes their features.

Features are words and pairs of neighbours, hashed into buckets. A bucket's gain
is the log ratio of its smoothed shares in the target and in the corpus; a
document's weight is the mean gain of its features. Adding Gumbel noise to the
weights and taking the largest scores draws without replacement in proportion
to the importance (Xie et al., "Data Selection for Language Models via
Importance Resampling", 2023).

Words come from an untrained ``Split`` of the tokenizers library. White space is
never part of a word, so the split runs once per distinct stretch between white
space; its offsets tell which words a stretch holds. The CRC of a pair follows
from the CRCs of its words: a CRC is linear, so no pair is ever built as text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlake.llm.staging import staged, unused
from shiftlake.llm.wordtable import WordTable

#: Words of ASCII-lowered text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 7
PERCENT = 25
LEAST_WORDS = 20
#: Stretches of text that are looked up in one go.
AT_ONCE = 200_000


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """What a zero byte after the text makes of a CRC, as a linear map."""
    table = np.array([_plain(b) for b in range(256)], np.uint32)
    return (crc >> np.uint32(8)) ^ table[crc & np.uint32(255)]


def _plain(byte: int) -> int:
    value = byte
    for _ in range(8):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


class CrcShift:
    """Moves CRCs past n bytes: crc32(a + b) == shift(crc32(a), len(b)) ^ crc32(b)."""

    SHORT = 64

    def __init__(self):
        lanes = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
        steps = [lanes]
        for _ in range(self.SHORT):
            steps.append(_zero_byte(steps[-1]))
        self._short = np.stack(steps[:self.SHORT])
        self._doubled = [steps[self.SHORT]]

    @staticmethod
    def _apply(lanes: np.ndarray, crc: np.ndarray) -> np.ndarray:
        eight = np.uint32(255)
        return (lanes[..., 0, :].reshape(-1)[crc & eight] ^ lanes[..., 1, :].reshape(-1)[(crc >> np.uint32(8)) & eight]
                ^ lanes[..., 2, :].reshape(-1)[(crc >> np.uint32(16)) & eight] ^ lanes[..., 3, :].reshape(-1)[crc >> np.uint32(24)])

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        low, eight = n % self.SHORT, np.uint32(255)
        t = self._short
        out = (t[low, 0, crc & eight] ^ t[low, 1, (crc >> np.uint32(8)) & eight]
               ^ t[low, 2, (crc >> np.uint32(16)) & eight] ^ t[low, 3, crc >> np.uint32(24)])
        rest, power = n // self.SHORT, 0
        while rest.any():
            if power == len(self._doubled):
                self._doubled.append(self._apply(self._doubled[-1], self._doubled[-1]))
            odd = rest & 1 == 1
            out[odd] = self._apply(self._doubled[power], out[odd])
            rest, power = rest >> 1, power + 1
        return out


class FeatureHasher:
    """CRC buckets of the features of texts."""

    def __init__(self, buckets: int = BUCKETS):
        from tokenizers import Regex, pre_tokenizers

        self._buckets = buckets
        self._split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self._shift = CrcShift()
        # A word is its CRC above its length in bytes.
        self._words = WordTable(self._expand, limit=600_000)

    def _expand(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [s.decode("utf-8", "replace") for s in stretches]
        found = self._split.pre_tokenize_str(" ".join(texts))
        starts = np.zeros(len(texts), np.int64)
        np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
        offsets = np.fromiter((span[0] for _, span in found), np.int64, len(found))
        owner = np.searchsorted(starts, offsets, "right") - 1
        raw = [word.encode() for word, _ in found]
        values = np.fromiter((zlib.crc32(w) << 31 | len(w) for w in raw), np.int64, len(raw))
        return values, np.bincount(owner, minlength=len(texts)).astype(np.int64)

    def _features(self, stretches: list[bytes], ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = self._words.codes(stretches)
        words = self._words.runs(codes)
        before = np.concatenate([[0], np.cumsum(self._words.sizes(codes))])
        n_words = np.diff(before[np.concatenate([[0], ends]).astype(np.int64)])
        text = np.repeat(np.arange(len(ends)), n_words)
        crc, size = (words >> 31).astype(np.uint32), words & 0x7FFFFFFF
        paired = np.flatnonzero(text[1:] == text[:-1])
        spaced = self._shift(crc[paired], np.ones(len(paired), np.int64)) ^ np.uint32(zlib.crc32(b" "))
        pairs = self._shift(spaced, size[paired + 1]) ^ crc[paired + 1]
        hashes = np.concatenate([crc, pairs]) % np.uint32(self._buckets)
        return n_words, np.concatenate([text, text[paired]]), hashes.astype(np.int64)

    def many(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Groups of texts in order: (words of each, number within the group of each feature's text, its bucket)."""
        stretches: list[bytes] = []
        ends: list[int] = []
        for text in texts:
            stretches += (text or "").encode("utf-8", "replace").lower().split()
            ends.append(len(stretches))
            if len(stretches) >= AT_ONCE:
                yield self._features(stretches, ends)
                stretches, ends = [], []
        if ends:
            yield self._features(stretches, ends)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Summed per task first; a row per bucket reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = FeatureHasher(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, hashes in hasher.many(batch.column(0).to_pylist()):
                total += np.bincount(hashes, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of smoothed shares per bucket, floored."""
    all_corpus, all_target, n = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array([math.floor(1000.0 * math.log((t + 1.0) * (all_corpus + n) / ((s + 1.0) * (all_target + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document, times 1000, from a digest of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, check (xxhash64 of the text), n_words, n_features, weight, score of every row."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = FeatureHasher(buckets)
        for batch in batches:
            words, sums = [], []
            for n_words, text, hashes in hasher.many(batch.column(2).to_pylist()):
                total = np.zeros(len(n_words), np.int64)
                np.add.at(total, text, gains[hashes])
                words.append(n_words)
                sums.append(total)
            n = np.concatenate(words) if words else np.zeros(0, np.int64)
            features = np.maximum(0, 2 * n - 1)
            weight = (np.concatenate(sums) if sums else n) // np.maximum(1, features)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(features), pa.array(weight)],
                                             names=["doc_id", "check", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("check"), "text")
    weighed = rows.mapInArrow(run, "doc_id long, check long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """A row per document: doc_id, check, n_words, n_features, weight, score, and its rank in the draw (null: not drawn).

    Of the N rows with ``least_words`` words, floor(percent * N / 100) are drawn:
    the highest scores, ties to the smaller doc_id. Null and empty texts have no
    features and weight 0. A null doc_id counts as an empty one in the noise and
    comes last among ties. Rows that repeat a doc_id are rows of their own;
    equal ones share no rank. Other columns are not read; no rows give no rows,
    and an empty target leaves the smoothed corpus alone to decide.

    Scores are whole numbers of a bounded range (about a hundred thousand), so
    ranks follow from a count per score and an order within each score: no row
    passes through a single task, and undrawn scores are never sorted.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = staged(weigh(docs, gains, seed), "importance")
    enough = F.col("n_words") >= least_words
    per_score = scored.where(enough).groupBy("score").agg(F.count("*").alias("n"))
    # The counts per score are few whatever the corpus, so one ordered pass over them is no bottleneck.
    falling = Window.orderBy(F.desc("score"))
    to_draw = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).cast("long")
    before = F.coalesce(F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = per_score.select(F.col("score").alias("of_score"), before.alias("before"), to_draw.alias("to_draw")).where("before < to_draw")
    met = scored.join(F.broadcast(open_), enough & (F.col("score") == F.col("of_score")), "left")
    own = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight", "check")
    out = ["doc_id", "check", "n_words", "n_features", "weight", "score"]
    ranked = met.where("of_score is not null").select(*out, "to_draw", (F.col("before") + F.row_number().over(own)).cast("long").alias("rank"))
    drawn = ranked.select(*out, F.when(F.col("rank") <= F.col("to_draw"), F.col("rank")).alias("rank"))
    return drawn.unionByName(met.where("of_score is null").select(*out, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``drawn`` (of ``resample``) has a rank for, with all their columns.

    Rows that repeat doc_id and text are drawn together."""
    name, sum_ = unused(docs, "drawn_id"), unused(docs, "drawn_check")
    keys = drawn.where("rank is not null").select(F.col("doc_id").alias(name), F.col("check").alias(sum_)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (F.xxhash64("text") == F.col(sum_))
    return docs.join(keys, same, "left_semi")
