"""Quality of whole texts by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a vector of weighted terms: hashed character n-grams of its words and
a few shape terms (how often words repeat, how many are no words). A truncated
singular value decomposition of the labelled sample gives the latent space.
The labelled vectors are broadcast (their number is bounded), every document
meets all of them in exact blocked cosine products, and its nearest labels vote
with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.grams import word_grams
from shiftlake.llm.labels import training_texts
from shiftlake.llm.wordtable import WordTable

SIZES, BITS = (1, 2, 3), 12
GRAMS = 1 << BITS
STEPS = 11
SHAPES = 6
TERMS = GRAMS + SHAPES * STEPS
#: Labelled documents that are gathered and broadcast at most.
MOST_LABELLED = 4000
THRESHOLD = 0.7
BLOCK = 256


@dataclass
class Model:
    weight: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: int

    def weighted(self, terms: np.ndarray) -> np.ndarray:
        grams = terms[:, :GRAMS] * self.weight[:GRAMS]
        grams /= np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-9)
        return np.hstack([grams, terms[:, GRAMS:] * self.weight[GRAMS:]])

    def latent(self, terms: np.ndarray) -> np.ndarray:
        found = self.weighted(terms) @ self.space
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)

    def vote(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        alike = self.latent(terms) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-alike, k - 1, axis=1)[:, :k]
        say = np.maximum(np.take_along_axis(alike, near, 1), 1e-6).astype(np.float64) ** self.power
        return (say * self.labels[near]).sum(1) / say.sum(1)


class Terms:
    """Term weights of a text before inverse frequencies; keeps a word table for its task."""

    def __init__(self):
        def expand(words):
            bucket, sizes = word_grams(words, SIZES, BITS)
            # Two more buckets count words that start with no letter, and upper-case words.
            odd = np.array([not w[0].isalpha() for w in words], bool)
            loud = np.array([len(w) > 1 and w.isupper() for w in words], bool)
            owner = np.concatenate([np.repeat(np.arange(len(words)), sizes), np.flatnonzero(odd), np.flatnonzero(loud)])
            bucket = np.concatenate([bucket, np.full(odd.sum(), GRAMS), np.full(loud.sum(), GRAMS + 1)])
            order = np.argsort(owner, kind="stable")
            return bucket[order], np.bincount(owner, minlength=len(words))

        self._table = WordTable(expand)

    def __call__(self, text: str | None) -> np.ndarray:
        out = np.zeros(TERMS, np.float32)
        words = (text or "").split()
        n = len(words)
        if not n:
            return out
        code = self._table.codes(words)
        counts = np.bincount(self._table.runs(code), minlength=GRAMS + 2)
        out[:GRAMS] = np.log1p(counts[:GRAMS])
        lines = text.split("\n")
        mixed = code[2:] + 1000003 * code[1:-1] + 1000033 * 1000003 * code[:-2]
        shapes = (len(np.unique(code)) / n ** 0.85, (code[1:] == code[:-1]).sum() / n, len(np.unique(mixed)) / max(n - 2, 1),
                  counts[GRAMS] / n, counts[GRAMS + 1] / n, len(set(lines)) / len(lines))
        for k, share in enumerate(shapes):
            out[GRAMS + k * STEPS + min(STEPS - 1, int(np.ceil((STEPS - 1) * share)))] = 1
        return out


def fit(texts: DataFrame, rank: int = 64, neighbours: int = 7, power: int = 4, shape_weight: float = 1.0, seed: int = 7) -> Model:
    """Latent space and labelled vectors of a bounded sample; without rows every score is a half."""
    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            rows = [terms(t) for t in batch.column("text").to_pylist()]
            at = [np.flatnonzero(r).astype(np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("label"), pa.array(at, pa.list_(pa.int32())),
                 pa.array([r[a] for r, a in zip(rows, at)], pa.list_(pa.float32()))], names=["doc_id", "label", "term", "value"])

    got = texts.select("doc_id", "label", "text").mapInArrow(
        featured, "doc_id long, label int, term array<int>, value array<float>").toArrow().sort_by("doc_id")
    labels = np.array(got["label"]).astype(np.float64)
    matrix = np.zeros((len(labels), TERMS), np.float32)
    for row, (term, value) in enumerate(zip(got["term"], got["value"])):
        matrix[row, np.array(term.values)] = np.array(value.values)
    known = (matrix > 0).sum(0)
    weight = np.log((1 + len(labels)) / (1 + known)).astype(np.float32)
    weight[GRAMS:] = shape_weight / SHAPES ** 0.5
    model = Model(weight, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, neighbours, power)
    if not len(labels):
        return model
    model.space = _right_space(model.weighted(matrix), rank, seed)
    model.vectors = model.latent(matrix)
    return model


def _right_space(matrix: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Leading right singular vectors, by randomised subspace iteration."""
    wide = min(rank + 16, *matrix.shape)
    basis = np.random.default_rng(seed).standard_normal((matrix.shape[1], wide)).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turn.T)[:, :rank]).astype(np.float32)


def score(text: Column, model: Model) -> Column:
    """Share of label 1 among the nearest labelled texts, weighted by similarity; null and empty texts are alike to none."""
    def scores(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        for texts in series:
            values = texts.tolist()
            votes = [model.vote(np.stack([terms(t) for t in values[i:i + BLOCK]])) for i in range(0, len(values), BLOCK)]
            yield pd.Series(np.concatenate(votes) if votes else np.zeros(0), dtype="float64")

    return F.pandas_udf(scores, "double")(text)


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> Model:
    return fit(training_texts(docs, labels, label, most))
