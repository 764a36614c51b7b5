"""Registered queries of this package: thin views of its operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.llm import (decontaminate, exact_dedup, html_text, huffman, importance, packing, quality, simhash, spelling,
                           substring_dedup, toxicity, url_filter, warc)
from shiftlake.llm.labels import held_out

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def _judged(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, toxicity.score(F.col("text"), model), toxicity.THRESHOLD)


@query
def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, quality.score(F.col("text"), model), quality.THRESHOLD)


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_classes(table(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark, sf_dir):
    _, placed = packing.pack(table(spark, sf_dir, "documents"))
    return placed.drop("shard", "nth")


@query
def op7_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_token_output(spark, sf_dir):
    path = huffman.write_corpus(table(spark, sf_dir, "documents"))
    return huffman.read_corpus(spark, path, digest_only=True).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_warc_revisits(spark, sf_dir):
    path = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_importance_resampling(spark, sf_dir):
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


SQL: dict[str, str] = {
    "op12_warc_revisits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
             g AS (SELECT t, min(page_id) AS first FROM p GROUP BY t),
             q AS (SELECT page_id, first, strlen(t) AS payload_bytes, sha1(t) AS digest FROM p JOIN g USING (t))
        SELECT page_id, payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
                   ((CAST('0x' || substr(digest, CAST(5 * (i // 4) + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)
                   FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM q""",
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
}
