"""The pipeline's decisions, stage by stage, against brute force on the smallest table."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shiftlake.llm import queries, toxicity
from shiftlake.llm.staging import staged
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_operators import brute_distance
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    functions = dict(corpus_pipeline.STAGES)
    seen = docs
    after = {}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        seen = staged(fn(spark, seen, SF), f"test-{name}")
        assert seen.columns == docs.columns
        after[name] = {r.doc_id for r in seen.select("doc_id").collect()}
    model = toxicity.fit_on(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()}
    left = {d for d in rows if scores[d] < toxicity.THRESHOLD}
    assert after["toxicity"] == left
    left = {max(d for d in left if rows[d] == rows[e]) for e in left}
    assert after["exact_dedup"] == left
    kept = {d for d, _ in brute_kept([(d, rows[d]) for d in sorted(left)])}
    assert after["near_dedup"] == kept and len(kept) < len(left)
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d in kept if not any(_holds(i, rows[d].lower().split()) for i in items)}
    assert after["decontamination"] == clean
    packed = functions["packing"](spark, seen, SF).collect()
    assert {r.doc_id for r in packed} == clean
    whole = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == \
        Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def _holds(item, words):
    if not set(item) & set(words):
        return False
    if " ".join(item) in " ".join(words):
        return True
    # A passage within the edits keeps a block of three words.
    blocks = {tuple(item[i:i + 3]) for i in range(len(item) - 2)}
    if not any(tuple(words[i:i + 3]) in blocks for i in range(len(words) - 2)):
        return False
    return brute_distance(item, words) <= int(0.2 * len(item) + 1e-9)


def test_stages_take_odd_rows(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (2, ""), (None, "the of and"), (3, " ".join(rng.choices("abc", k=3000))), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("run", F.lit("r"))
    for table in (docs, docs.limit(0)):
        seen = table
        for name, fn in corpus_pipeline.STAGES:
            seen = staged(fn(spark, seen, SF), f"odd-{name}")
        assert (seen.count() > 0) == (table.count() > 0)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    with connect(SF) as con:
        ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_queries_are_registered():
    assert sorted(queries.REGISTRY, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_url_filter", "op2_substring_dedup", "op3_toxicity", "op4_quality", "op5_simhash", "op6_best_fit_packing",
        "op7_html_text", "op8_decontamination", "op9_token_output", "op10_exact_dedup", "op11_spelling_variants",
        "op12_warc_revisits", "op13_importance_resampling"]
