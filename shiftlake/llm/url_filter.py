"""URL verdicts: written rules first, then logistic regression on hashed character n-grams of host and path.

Everything is DataFrame work: n-grams, hashes and scores are SQL functions, the
model is fitted by Spark ML on the labelled table, and its weights enter the
scoring expression as one constant array.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))

# The small labelled table: names that link farms, betting, pill and adult
# sites use, and names of ordinary sites; each meets each of the paths.
BLOCK_NAMES = ("spam-farm", "spamlinks", "link-farm", "free-bets", "bets-online", "casino-bonus", "casino-wins", "cheap-pills",
               "pills-shop", "adult-cams", "adult-videos", "x-adult", "free-xxx", "ad-tracker", "ads-tracking", "replica-watches")
ALLOW_NAMES = ("daily-news", "the-times", "university", "library", "weather", "thereader", "cooking", "gardening",
               "travel-notes", "science", "history", "museum", "therunner", "nation", "theother", "onlinebooks",
               "notable", "double-bass", "reasonable", "station", "there-and-then", "writing", "landing", "potential")
BLOCK_PATHS = ("/en/12", "/fr/825?page=2", "/de/free-bonus", "/es/7.html")
ALLOW_PATHS = ("/en/12", "/fr/825?page=2", "/de/articles/", "/es/7.html")
PREFIXES = ("", "www.", "blog.", "m.")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, label (1: block): 16 names to block and 24 to allow, x 4 paths."""
    rows = []
    for names, paths, label in ((BLOCK_NAMES, BLOCK_PATHS, 1), (ALLOW_NAMES, ALLOW_PATHS, 0)):
        for i, name in enumerate(names):
            for k, path in enumerate(paths):
                rows.append((f"https://{PREFIXES[(i + k) % 4]}{name}.example.{('com', 'net', 'org')[(i + k) % 3]}{path}", label))
    return spark.createDataFrame(rows, "url string, label int").coalesce(1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path that starts with the rule's."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def gram_ids(host: Column, path: Column, sizes: Sequence[int], buckets: int) -> Column:
    """Distinct hashed n-grams; host and path have n-grams of their own."""
    def grams(tag: str, text: Column, n: int) -> Column:
        at = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.pmod(
            F.xxhash64(F.lit(f"{tag}{n}"), F.substring(text, i, F.lit(n))), F.lit(buckets)).cast("int"))

    bounded = F.concat(F.lit("."), host, F.lit("."))
    parts = [grams(tag, text, n) for tag, text in (("h", bounded), ("p", path)) for n in sizes]
    return F.array_distinct(F.flatten(F.array(*parts)))


def fit(labelled: DataFrame, sizes: Sequence[int] = (3, 4, 5), buckets: int = 4096, strength: float = 0.001) -> tuple[list[float], float]:
    """(weight of each bucket, intercept). Rows without a url or label are left out."""
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL").select(
        F.col("label").cast("double").alias("label"),
        gram_ids(host_of(F.col("url")), path_of(F.col("url")), sizes, buckets).cast("array<string>").alias("ids"))
    vocabulary = CountVectorizer(inputCol="ids", outputCol="features", binary=True, vocabSize=buckets).fit(rows)
    model = LogisticRegression(regParam=strength, maxIter=25, standardization=False).fit(vocabulary.transform(rows))
    weights = [0.0] * buckets
    for bucket, weight in zip(vocabulary.vocabulary, model.coefficients.toArray()):
        weights[int(bucket)] = round(float(weight), 6)
    return weights, round(float(model.intercept), 6)


def block_probability(host: Column, path: Column, weights: Sequence[float], intercept: float, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    table = F.from_json(F.lit(json.dumps(list(weights))), "array<double>")
    total = F.aggregate(gram_ids(host, path, sizes, len(weights)), F.lit(float(intercept)),
                        lambda done, i: done + F.element_at(table, i + 1))
    return 1 / (1 + F.exp(-total))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
          threshold: float = 0.5) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, score.

    A null url, and one without ``://``, has an empty host and path, no rule,
    and the model's verdict on no n-grams. Repeated rows are judged one by one;
    extra columns are not read; no rows give no rows.
    """
    weights, intercept = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("score", block_probability(F.col("host"), F.col("path"), weights, intercept))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    by_model = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_model).alias("verdict"), "score")
