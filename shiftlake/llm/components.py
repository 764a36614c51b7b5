"""Connected components of a link table, by alternating large and small stars.

Every round is two joins and a written table; nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.staging import staged


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them: larger neighbours, or no larger ones."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    near = (both.unionByName(turned).where("v < u") if small else both.unionByName(turned))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = near.join(least, "u")
    if small:
        links = joined.select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
    else:
        links = joined.where("v > u").select("v", "m")
    found = links.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    # Twice the same link does no harm between the two halves of a round.
    return found.distinct() if small else found


def roots(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every linked node; root is the smallest node reachable. ``links`` has a and b."""
    # Copies of a link go with the first round.
    edges = staged(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")

    def print_of(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = print_of(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        edges = staged(_stars(_stars(edges, small=False), small=True), "stars")
        now = print_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components have not settled")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
