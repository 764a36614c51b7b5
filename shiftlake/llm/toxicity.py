"""Toxicity of whole texts: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the hashed n-grams of its words with the logarithm of how often each
occurs. Log-count ratios of toxic against other labelled texts scale each
n-gram; logistic regression is fitted on the scaled n-grams; the product of
weight and ratio is what scoring looks up, so a text costs one look-up per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.grams import word_grams
from shiftlake.llm.labels import training_texts
from shiftlake.llm.wordtable import WordTable

SIZES, BITS = (3, 4, 5), 18
#: Labelled documents a fit gathers at most.
MOST_LABELLED = 4000
THRESHOLD = 0.3
#: n-grams of a text from which they are counted per bucket.
MANY = 1 << 14


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def probability(self, total: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(total + self.intercept, -500, 500))))


def _counted(table: WordTable, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram buckets of a text, their counts)."""
    found = table.expand((text or "").lower().split())
    if len(found) < MANY:
        return np.unique(found, return_counts=True)
    # Counting all buckets is cheaper than sorting that many n-grams.
    counts = np.bincount(found, minlength=1 << BITS)
    grams = np.flatnonzero(counts)
    return grams, counts[grams]


def _damped(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts.astype(np.float32))


def gram_table(weights: np.ndarray | None = None) -> WordTable:
    """n-gram buckets per word; with weights, only of n-grams that have one."""
    def expand(words):
        bucket, sizes = word_grams(words, SIZES, BITS)
        if weights is None:
            return bucket, sizes
        keep = weights[bucket] != 0
        owner = np.repeat(np.arange(len(words)), sizes)[keep]
        return bucket[keep], np.bincount(owner, minlength=len(words))

    return WordTable(expand, limit=200_000, dtype=np.int32)


#: Entries that are worked on at once, which bounds the memory of a fit beside its sample.
ENTRIES_AT_ONCE = 1 << 20


def _summed(into: np.ndarray, weights: Callable[[slice], np.ndarray], width: int) -> np.ndarray:
    """Sum of ``weights`` by the buckets ``into``, block by block."""
    out = np.zeros(width)
    for at in range(0, len(into), ENTRIES_AT_ONCE):
        part = slice(at, at + ENTRIES_AT_ONCE)
        out += np.bincount(into[part], weights=weights(part), minlength=width)
    return out


def _logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, labels: np.ndarray, width: int,
              strength: float, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on sparse rows, by limited-memory BFGS."""
    n = len(labels)

    def at(w):
        z = _summed(rows, lambda p: w[cols[p]] * values[p], n) + w[width]
        slope = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels
        gradient = np.append(_summed(cols, lambda p: slope[rows[p]] * values[p], width) + strength * w[:width], slope.sum())
        return np.logaddexp(0, z).sum() - labels @ z + strength / 2 * (w[:width] @ w[:width]), gradient

    w = np.zeros(width + 1)
    loss, gradient = at(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, kept = gradient.copy(), []
        for moved, turned in reversed(steps):
            share = moved @ way / (turned @ moved)
            way -= share * turned
            kept.append(share)
        if steps:
            moved, turned = steps[-1]
            way *= moved @ turned / (turned @ turned)
        for (moved, turned), share in zip(steps, reversed(kept)):
            way += moved * (share - turned @ way / (turned @ moved))
        scale = 1.0 if steps else 1 / max(np.abs(gradient).sum(), 1e-12)
        while True:
            tried = w - scale * way
            new_loss, new_gradient = at(tried)
            if new_loss <= loss - 1e-4 * scale * (way @ gradient) or scale < 1e-10:
                break
            scale /= 2
        moved, turned = tried - w, new_gradient - gradient
        if moved @ turned > 1e-12:
            steps = [*steps[-7:], (moved, turned)]
        done = abs(loss - new_loss) < 1e-5 * abs(loss)
        w, loss, gradient = tried, new_loss, new_gradient
        if done:
            break
    return w[:width], float(w[width])


def fit(texts: DataFrame, alpha: float = 1.0, strength: float = 1.0, least_texts: int = 3) -> Model:
    """Model of ``label`` (0 or 1) on ``text``; ``texts`` is a bounded sample.

    n-grams of fewer than ``least_texts`` texts have no say. Without texts of both classes every
    score is the share of label 1 (a half where there are none).
    """
    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gram_table()
        for batch in batches:
            found = [_counted(table, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("label"),
                 pa.array([g.astype("<i4").tobytes() for g, _ in found], pa.binary()),
                 pa.array([n.astype("<i4").tobytes() for _, n in found], pa.binary())],
                names=["doc_id", "label", "grams", "counts"])

    got = texts.select("doc_id", "label", "text").mapInArrow(featured, "doc_id long, label int, grams binary, counts binary").toArrow()
    order = np.argsort(np.array(got["doc_id"]), kind="stable").tolist()
    labels = np.array(got["label"]).astype(float)[order]
    width = 1 << BITS
    if len(labels) == 0 or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(width, np.float32), float(np.log(share / (1 - share))))
    sizes = np.array([len(got["grams"][k].as_buffer()) // 4 for k in order])
    cols = np.frombuffer(b"".join(got["grams"][k].as_buffer() for k in order), "<i4")
    counts = _damped(np.frombuffer(b"".join(got["counts"][k].as_buffer() for k in order), "<i4"))
    del got
    rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    texts_with = np.bincount(cols, minlength=width)
    all_counts = _summed(cols, lambda p: counts[p], width)
    toxic = _summed(cols, lambda p: counts[p] * labels[rows[p]], width)
    ratio = np.log((toxic + alpha) / (toxic + alpha).sum()) - np.log((all_counts - toxic + alpha) / (all_counts - toxic + alpha).sum())
    ratio[texts_with < least_texts] = 0
    used = ratio[cols] != 0
    rows, cols, counts = rows[used], cols[used], counts[used]
    weights, intercept = _logistic(rows, cols, ratio.astype(np.float32)[cols] * counts, labels, width, strength)
    weights *= ratio
    return Model(weights.astype(np.float32), intercept)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 of each whole text; null and empty texts score the intercept."""
    def scores(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, weights = gram_table(model.weights), model.weights
        for texts in series:
            totals = []
            for text in texts:
                grams, counts = _counted(table, text)
                totals.append(float(weights[grams] @ _damped(counts)))
            yield pd.Series([model.probability(t) for t in totals], dtype="float64")

    return F.pandas_udf(scores, "double")(text)


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> Model:
    return fit(training_texts(docs, labels, label, most))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose text scores below ``threshold``, with all their columns."""
    return docs.where(score(F.col("text"), model) < threshold)
