"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Rows are dealt over ``fan_in ** rounds`` runs by a hash of the row, never by
their text, so a text that a third of all rows share starts in every run. Each
run is reduced to one entry per digest; in every round ``fan_in`` runs meet and
are merged (Spark's aggregate sorts by digest and folds equal ones), until one
run is left. An entry counts the rows below it and keeps the row that stays.
The way back goes through the same runs: a row finds its class under (digest,
its own run), so no key of that join holds more than one run's share of a class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.staging import staged, unused

CLASS = ["digest", "n_bytes", "check"]


def digests(docs: DataFrame, normalise=lambda text: text) -> DataFrame:
    """One small row per input row. SHA-256 names a text; its length and an
    independent 64-bit hash verify it, so equal digests of different texts would stay apart."""
    text = normalise(F.coalesce(F.col("text"), F.lit("")))
    return docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("check"))


def _merge(runs: DataFrame, largest: bool) -> DataFrame:
    best = F.max if largest else F.min
    return runs.groupBy("run", *CLASS).agg(best("kept_row").alias("kept_row"), F.sum("n_rows").alias("n_rows"))


def exact_classes(docs: DataFrame, largest: bool = True, fan_in: int = 8, rounds: int = 2,
                  normalise=lambda text: text) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest (or smallest) doc_id stays. A null
    text counts as empty. Rows that repeat a doc_id and its text count one by
    one in group_size, and one of them is kept. A null doc_id ranks below all
    others for the largest, above all for the smallest; it stays only where all
    ids of the class are null. Extra columns are not read; no rows give no rows.
    """
    rows = staged(digests(docs, normalise), "digests")
    rows = rows.withColumn("run", F.pmod(F.xxhash64("row_no"), F.lit(fan_in ** rounds)))
    known = F.col("doc_id").isNotNull()
    rank: Column = F.struct(known.alias("known"), "doc_id", "row_no") if largest \
        else F.struct((~known).alias("unknown"), "doc_id", "row_no")
    leaves = _merge(rows.select("run", *CLASS, rank.alias("kept_row"), F.lit(1).cast("long").alias("n_rows")), largest)
    merged = leaves
    for _ in range(rounds):
        merged = _merge(merged.withColumn("run", F.floor(F.col("run") / fan_in)), largest)
    found = leaves.select("run", *CLASS).join(
        merged.select(*CLASS, F.col("kept_row.doc_id").alias("keep_id"), F.col("kept_row.row_no").alias("keep_row"),
                      F.col("n_rows").alias("group_size")), CLASS)
    return rows.join(found, ["run", *CLASS]).select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, largest: bool = True) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows to drop are named by doc_id and digest (null-safe). Of rows that
    repeat both, one stays.
    """
    ident, sha, stays, times = (unused(docs, n) for n in ("gone_id", "gone_sha", "stays", "times"))
    gone = exact_classes(docs, largest).groupBy(F.col("doc_id").alias(ident), F.col("text_sha256").alias(sha)).agg(
        F.max("kept").alias(stays), F.count("*").alias(times)).where(~F.col(stays) | (F.col(times) > 1))
    own_sha = F.sha2(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"), 256)
    marked = docs.join(gone, docs["doc_id"].eqNullSafe(F.col(ident)) & (own_sha == F.col(sha)), "left")
    once = marked.where(F.col(stays).isNull()).select(*docs.columns)
    again = marked.where(stays).dropDuplicates([ident, sha]).select(*docs.columns)
    return once.unionByName(again)
