"""The labelled rows that a text model learns from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2: never learnt from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text, label of at most ``most`` labelled documents, chosen by a hash of the id.

    ``most`` bounds what a fit gathers, and so makes the sample safe to broadcast.
    Rows without id or label are left out; where a doc_id has two labels the larger counts,
    where it has several texts the first in order, so that rows are as bounded as labels.
    """
    chosen = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
