"""Spelling variants: words one insertion, deletion or replacement apart, and the common form each rare one goes to.

One error leaves one half of a word untouched. So words are dealt by their
halves: as a pattern by the own first (or second) half, as an entry of an index
by each half that a pattern one symbol shorter or as long would have. Bundles of
halves of bounded size become bidirectional FM-indexes over their delimited
words; patterns match the half exactly from the middle outwards and are then
extended over the other half with one error. A half whose words exceed a bundle
is cut into blocks that all meet, so no group has to fit into one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.fm_index import FmIndex
from shiftlake.llm.staging import staged

LEAST_LENGTH = 7
LEAST_TIMES = 2
#: How much more frequent a form has to be than its variant.
TIMES_MORE = 10
#: One run of a document in so many is damaged, see ``runs``.
DAMAGED = 31
#: Words of an index, and rows (entries and patterns) of a bundle.
INDEX_WORDS = 10_000
BUNDLE_ROWS = 20_000
#: Longer words are compared half by half as digests of this many hexadecimal digits.
LONG_HALF = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else. ``lower`` does that where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES) -> DataFrame:
    """word, n of the letter runs of all texts, with those damaged whose checksum says so.

    A run is damaged if ``DAMAGED`` divides the CRC-32 of ``<doc_id>:<run>``: it
    loses the code point at the checksum modulo its length. A null doc_id is
    written as nothing. Runs too short to become a word are not even listed.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    words = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    words = words.select("id", lower_ascii(F.col("run")).alias("run"))
    words = words.select("run", F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = words.select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def _half(side: str, part: Column) -> Column:
    """Name of a half on its side; a digest stands for a very long one."""
    return F.concat(F.lit(side), F.when(F.length(part) <= LONG_HALF, part).otherwise(F.sha2(F.encode(part, "UTF-8"), 256)))


def _dealt(words: DataFrame) -> DataFrame:
    """half, is_entry, word, n: a word as pattern and as entry under the halves where it can be found."""
    size = F.length("word")

    def front(n: Column) -> Column:
        return _half("<", F.substring("word", F.lit(1), F.floor(n / 2).cast("int")))

    def back(n: Column) -> Column:
        # The second half of a pattern of n symbols has the middle one.
        return _half(">", F.substring("word", (size - F.ceil(n / 2) + 1).cast("int"), size))

    patterns = F.array(front(size), back(size))
    entries = F.array_distinct(F.array(front(size), front(size - 1), back(size), back(size - 1)))
    rows = [words.select("word", "n", F.lit(flag).alias("is_entry"), F.explode(halves).alias("half"))
            for flag, halves in ((False, patterns), (True, entries))]
    return rows[0].unionByName(rows[1])


PAIR = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _search_bundle(table: pa.Table) -> pa.Table:
    """word, n, near, near_n of one bundle, the word being the shorter or as long."""
    words, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
    names = words.to_pylist()
    entry = table.column("is_entry").to_numpy()
    front = pc.equal(pc.utf8_slice_codeunits(table.column("half"), 0, 1), "<").to_numpy()
    parts = [PAIR.empty_table()]
    for exact_first in (True, False):
        side = front == exact_first
        # A word is an entry under several halves, but indexed once.
        indexed = {names[i]: i for i in np.flatnonzero(entry & side).tolist()}
        asked = {names[i]: i for i in np.flatnonzero(~entry & side).tolist()}
        if not indexed or not asked:
            continue
        at, found = FmIndex(list(indexed)).near(list(asked), exact_first)
        pairs = np.unique(at * len(indexed) + found)
        at, found = pairs // len(indexed), pairs % len(indexed)
        left = np.fromiter(asked.values(), np.int64, len(asked))[at]
        right = np.fromiter(indexed.values(), np.int64, len(indexed))[found]
        parts.append(pa.Table.from_arrays([words.take(pa.array(left)), pa.array(n[left]), words.take(pa.array(right)), pa.array(n[right])], schema=PAIR))
    return pa.concat_tables(parts)


def near_pairs(words: DataFrame, index_words: int = INDEX_WORDS, bundle_rows: int = BUNDLE_ROWS) -> DataFrame:
    """word, n, near, near_n of all words exactly one error apart, each pair in both orders. ``words`` (word, n) is written before."""
    dealt = staged(_dealt(words), "halves")
    # A half that only one word has finds nothing.
    shared = dealt.groupBy("half").agg(F.min("word").alias("one"), F.max("word").alias("other"), F.count("*").alias("rows")).where("one < other")
    shared = staged(shared.select("half", F.ceil(F.col("rows") / index_words).cast("int").alias("blocks")), "shared-halves")
    met = dealt.join(shared, "half")
    # Each block of entries meets each block of patterns: an entry goes to a row of blocks, a pattern to a column.
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.when(F.col("is_entry"), own * F.col("blocks") + k).otherwise(k * F.col("blocks") + own))
    met = met.select("half", "is_entry", "word", "n", F.explode(places).alias("block"))
    rows = words.count() * 6
    bundles = max(1, -(-rows // bundle_rows))
    met = met.withColumn("bundle", F.pmod(F.xxhash64("half", "block"), F.lit(bundles)).cast("int"))
    found = met.groupBy("bundle").applyInArrow(_search_bundle, "word string, n long, near string, near_n long")
    # The search runs once: a pair is kept in one order, whichever of its words found the other, and only then turned.
    word, near = F.struct("word", "n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"))
    found = found.select(F.least(word, near).alias("a"), F.greatest(word, near).alias("b")).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")).distinct()
    orders = F.array(F.struct("word", "n", "near", "near_n"),
                     F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return found.select(F.inline(orders))


def follow(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): the last word on the way from form to form, doubling the reached distance per round.

    A form is ``TIMES_MORE`` times as frequent as its word, so a way has no
    circle and no more steps than a count has digits.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return roots


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, times_more: int = TIMES_MORE) -> DataFrame:
    """A row per word of all texts: word, n, n_near (words one error apart), form, form_n, root.

    The form is the most frequent near word (ties: the smaller in code-point
    order) if it is at least ``times_more`` as frequent, else null; the root is
    the end of the chain of forms, the word itself where there is none. Null and
    empty texts have no words; rows that repeat a doc_id count each. Other
    columns are not read; no rows give no rows.
    """
    words = staged(vocabulary(docs, least_length, least_times), "vocabulary")
    near = near_pairs(words)
    best = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.when(-F.col("best.less") >= times_more * F.col("n"), F.col("best")).alias("best"))
    best = staged(best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    roots = follow(best.where("form is not null"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
