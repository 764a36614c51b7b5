"""Spelling variants, WARC archives and importance resampling against brute force, and their edge cases."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlake.llm import importance, salted, spelling, warc
from shiftlake.llm.fm_index import FmIndex, suffix_order
from test_operators import make_docs, none, odd, odd_rows  # noqa: F401  fixtures


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Spelling ---------------------------------------------------------------------

def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_suffix_order():
    rng = random.Random(2)
    for n in (1, 2, 5, 60):
        text = np.array([rng.randint(1, 2) for _ in range(n)] + [0])
        assert suffix_order(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("alphabet", ["a", "ab", "abé", "abcdefghÿ"])
def test_index_finds_one_error(alphabet):
    rng = random.Random(3)
    for _ in range(15):
        words = sorted({"".join(rng.choices(alphabet, k=rng.randint(2, 9))) for _ in range(rng.randint(1, 50))})
        index, found = FmIndex(words), set()
        for exact_first in (True, False):
            at, near = index.near([*words, "zzzz"], exact_first)
            found |= {(i, j) for i, j in zip(at.tolist(), near.tolist())}
        assert {(words[i], words[j]) for i, j in found} == {
            (a, b) for a in words for b in words if len(b) >= len(a) and one_error(a, b)}


def brute_words(rows):
    times = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            times[run] += 1
    return {w: n for w, n in times.items() if len(w) >= 7 and n >= 2}


def brute_variants(rows):
    words = brute_words(rows)
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if abs(len(a) - len(b)) < 2 and one_error(a, b)]
    form = {}
    for a in words:
        if near[a]:
            best = min(near[a], key=lambda b: (-words[b], b))
            if words[best] >= 10 * words[a]:
                form[a] = best
    out = {}
    for a in words:
        root = a
        while root in form:
            root = form[root]
        out[a] = (words[a], len(near[a]), form.get(a), words.get(form.get(a)), root)
    return out


def chained_rows():
    """Chains of forms, ties between forms, accents, and a word in a third of all runs."""
    rng = random.Random(4)
    rows = [(k, "stepping " + "steppingg " * 20 + "Steppinggs " * 400) for k in range(8)]
    rows += [(10 + k, " ".join(["lanternes"] * 30 + ["lanternas"] * 30 + ["lanternxs"])) for k in range(2)]
    rows += [(20 + k, "Übermäßig übermäßig übermässig " + "".join(rng.choices("abcd", k=8)) * 2) for k in range(40)]
    rows += [(70 + k, " ".join("".join(rng.choices("ab", k=rng.randint(6, 9))) for _ in range(80))) for k in range(20)]
    return rows + [(90, "x" * 5000 + " " + "x" * 5001), (91, "x" * 5000 + " " + "x" * 5001), (92, "×÷" * 9)]


@pytest.mark.parametrize("index_words, bundle_rows", [(10_000, 20_000), (3, 10)])
def test_near_pairs_in_blocks(spark, index_words, bundle_rows):
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(7, 10))) for _ in range(150)})
    df = spark.createDataFrame([(w, k + 2) for k, w in enumerate(words)], "word string, n long")
    found = {(r.word, r.near) for r in spelling.near_pairs(df, index_words, bundle_rows).collect()}
    assert found == {(a, b) for a in words for b in words if a != b and one_error(a, b)}


def test_near_pairs_searches_once(spark, capsys):
    words = ["stepping", "steppings", "stepxing", "lanternes", "lanternas"]
    pairs = spelling.near_pairs(spark.createDataFrame([(w, k + 2) for k, w in enumerate(words)], "word string, n long"))
    pairs.explain()
    assert capsys.readouterr().out.count("FlatMapGroupsInArrow") == 1
    want = [(a, i + 2, b, j + 2) for i, a in enumerate(words) for j, b in enumerate(words) if a != b and one_error(a, b)]
    assert sorted((r.word, r.n, r.near, r.near_n) for r in pairs.collect()) == sorted(want)


def test_variants(spark, none):  # noqa: F811
    rows = odd_rows() + chained_rows()
    found = spelling.variants(make_docs(spark, rows)).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == brute_variants(rows)
    assert len(found) == len({r.word for r in found})
    assert {r.word: r.root for r in found}["stepping"] == "steppinggs"
    assert spelling.variants(none).collect() == []


# WARC -------------------------------------------------------------------------

def page_rows():
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n<p>x</p>\r\n\r\n"
    rows = [(k, f"http://h/{k}", f"<p>{k % 7}</p>") for k in range(30)]
    rows += [(40, "http://h/\r\nWARC-Type: revisit", tricky), (41, None, tricky), (42, "http://h/ü", "ü \U0001f600" * 9), (43, "u", None), (44, "u", ""),
             (45, "u", "y" * 3_000_000), (46, "v", "y" * 3_000_000), (None, "w", "<p>3</p>"), (None, "w", "only null ids"), (None, "w2", "only null ids")]
    return rows + [(3, "again", "<p>3</p>"), (50, "same", "twice"), (50, "same", "twice")]


def make_pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("payload", "salt", "strong", "original", "record_id", "value", "n", "content")])


def expected_records(rows, least_bytes=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        origin = first.get(html or "")
        revisit = len(raw) >= least_bytes and page_id != origin
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", origin if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_bytes", [0, 9])
def test_archives(spark, least_bytes):
    rows = page_rows()
    path = warc.write_archives(make_pages(spark, rows), least_bytes=least_bytes)
    read = warc.read_archives(spark, path)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.drop("payload", "url").collect()]
    assert sorted(found, key=repr) == expected_records(rows, least_bytes)
    assert Counter((r.page_id, r.payload) for r in read.collect()) == Counter((p, h or "") for p, _, h in rows)
    # A payload that several rows have is stored once.
    stored = warc.read_records(spark, path).where("length(payload) > 1000000").count()
    assert stored == 1


def test_archives_of_no_pages(spark):
    path = warc.write_archives(make_pages(spark, []))
    assert warc.read_archives(spark, path).collect() == []


def test_reader_of_members_and_broken_files():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    raw = [record % (n, b"z" * n) for n in (0, 5, 2_500_000)]
    members = b"".join(gzip.compress(r) for r in raw)
    for content in (members, gzip.compress(b"".join(raw))):
        assert [len(block) for _, block in warc.RecordReader(content)] == [0, 5, 2_500_000]
    for broken in (gzip.compress(raw[1][:-6]), gzip.compress(b"HTTP/1.1\r\n\r\n"), gzip.compress(record % (2, b"zzz")), gzip.compress(raw[0][:20])):
        with pytest.raises(ValueError):
            list(warc.RecordReader(broken))


def test_lookup_of_a_hot_key(spark):
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as k").withColumn("salt", salted.salt_of(F.col("id"), salts=16))
    known = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, v int")
    found = {r.id: r.v for r in salted.lookup(rows, known, "k", "salt").collect()}
    assert found == {i: 1 if i % 3 == 0 else 2 if i == 7 else None for i in range(1000)}
    assert salted.salts_for(0) == 16 and salted.salts_for(10 ** 12) == salted.MOST_SALTS


# Importance resampling ----------------------------------------------------------

def brute_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute_draw(rows, target):
    features = [brute_features(text) for _, text in rows]
    s = Counter(b for _, f in features for b in f)
    t = Counter(b for text in target for b in brute_features(text)[1])
    total_s, total_t = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (total_s + 10_000) / ((s[b] + 1.0) * (total_t + 10_000)))) for b in range(10_000)]
    out = []
    for (doc_id, _), (words, f) in zip(rows, features):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(f), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for rank, row in enumerate(able[:25 * len(able) // 100]):
        row[5] = rank + 1
    return sorted(map(tuple, out), key=repr)


def test_crc_of_joined_texts():
    rng = random.Random(6)
    texts = [bytes(rng.randbytes(n)) for n in (0, 1, 2, 3, 31, 63, 64, 65, 200, 70_001)]
    shift = importance.CrcShift()
    for a in texts:
        left = np.full(len(texts), zlib.crc32(a), np.uint32)
        joined = shift(left, np.array([len(b) for b in texts])) ^ np.array([zlib.crc32(b) for b in texts], np.uint32)
        assert joined.tolist() == [zlib.crc32(a + b) for b in texts]


def test_features():
    hasher = importance.FeatureHasher()
    texts = ["", None, "A", "a-b  C9 d", " \x00 ", "Ä é　x\n" * 50, "w" * 300 + " " + "v" * 100, "one, two;three \x1c four\x1cfive"]
    seen = list(hasher.many(texts))
    assert sum(len(n) for n, _, _ in seen) == len(texts)
    words, text, hashes = seen[0]
    for k, t in enumerate(texts):
        assert words[k] == len(brute_features(t)[0])
        assert sorted(hashes[text == k].tolist()) == sorted(brute_features(t)[1])


def test_resample(spark, none):  # noqa: F811
    rng = random.Random(7)
    rows = odd_rows() + [(300 + k, " ".join(rng.choices(["alpha", "Beta", "gamma7", "delta"], k=rng.randint(15, 40)))) for k in range(40)]
    rows += [(300, rows[-1][1]), (300, rows[-1][1]), (301, "x-" * 60_000)]
    target = ["alpha beta alpha", None, "", "alpha beta"]
    docs, items = make_docs(spark, rows), spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(docs, items)
    got = sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=repr)
    assert got == brute_draw(rows, target)
    kept = importance.drawn_documents(docs, found)
    assert kept.columns == docs.columns
    drawn = {(d, t) for (d, t), r in zip(rows, [None] * len(rows)) if any(x[0] == d and x[5] for x in got)}
    assert {(r.doc_id, r.text) for r in kept.collect()} <= drawn
    assert importance.resample(none, items).collect() == []
    assert importance.drawn_documents(none, importance.resample(none, items)).collect() == []
    assert importance.resample(docs, items.limit(0)).where("rank is not null").count() == sum(1 for r in got if r[5])
