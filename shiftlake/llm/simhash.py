"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits are cut into segments. Two that differ in at most
``bits`` differ in at most ``bits // segments`` within one of them, so each
distinct fingerprint probes a table of segment values with the small Hamming
ball around its own, and complete distances verify what it meets. Only distinct
fingerprints take part: exact and unchanged copies are one entry. At most
43,744 fingerprints lie within 3 bits of another, which bounds the links of an
entry whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.llm import components
from shiftlake.llm.staging import staged, unused

SEED = 42
SALTS = 64


def fingerprint(text: str | None, width: int = 3) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    line, n = b" ".join(words), max(1, len(words) - width + 1)
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def balls(bits: int, segments: int) -> list[list[int]]:
    """Per segment, the masks of up to ``bits // segments`` bits, shifted to their place in the segment."""
    width = 64 // segments
    return [[sum(1 << i for i in chosen) for r in range(bits // segments + 1) for chosen in combinations(range(width), r)]
            for _ in range(segments)]


def links(prints: DataFrame, bits: int = 3, segments: int = 2) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints within ``bits``, once. ``segments`` divides 64."""
    width = 64 // segments
    low = (1 << width) - 1

    def part(column, k):
        return F.shiftrightunsigned(column, k * width).bitwiseAND(F.lit(low)) if segments > 1 else column

    entries = prints.select(F.col("fp").alias("b"), F.posexplode(F.array(*[part(F.col("fp"), k) for k in range(segments)])).alias("segment", "value"))
    masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in ball]) for ball in balls(bits, segments)])
    probes = prints.select(F.col("fp").alias("a"), F.posexplode(masks).alias("segment", "ball")).select(
        "a", "segment", F.explode("ball").alias("mask"))
    own = F.coalesce(*[F.when(F.col("segment") == k, part(F.col("a"), k)) for k in range(segments)])
    probes = probes.select("a", "segment", own.bitwiseXOR(F.col("mask")).alias("value"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # A pair that meets in several segments counts in the first.
    earlier = F.lit(False)
    for k in range(segments - 1):
        earlier = earlier | ((F.col("segment") > k) & (F.bit_count(part(differ, k)) <= bits // segments))
    return probes.join(entries, ["segment", "value"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(differ) <= bits) & ~earlier).select("a", "b")


def near_classes(docs: DataFrame, width: int = 3, bits: int = 3, segments: int = 2) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links).

    Texts without words, null ones too, have fingerprint zero and are linked
    like any other. Rows that repeat a doc_id are rows of their own with the
    same smallest id. A null doc_id is never the smallest. Extra columns are
    not read; no rows give no rows.
    """
    rows = staged(fingerprints(docs, width), "fingerprints").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    # A fingerprint that a third of all rows share is reduced per salt first, and looked up per salt last.
    shares = rows.groupBy("salt", "fp").agg(F.min("doc_id").alias("least"))
    prints = staged(shares.groupBy("fp").agg(F.min("least").alias("least")), "prints")
    rooted = components.roots(links(prints, bits, segments))
    marked = prints.join(rooted, prints["fp"] == rooted["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = marked.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = shares.select("salt", "fp").join(marked.select("fp", "root").join(named, "root").drop("root"), "fp")
    return rows.join(lookup, ["salt", "fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One row of each class stays (the smallest doc_id), with all its columns. Rows without a doc_id stay."""
    name = unused(docs, "gone_id")
    gone = near_classes(docs, **options).where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
