"""Operators against brute force on small tables, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shiftlake.llm import (components, decontaminate, exact_dedup, html_text, huffman, packing, quality, simhash, substring_dedup,
                           toxicity, url_filter)
from shiftlake.llm.labels import held_out
from shiftlake.llm.staging import staged
from shiftlake.llm.tokens import TextEncoder, default_tokenizer

SF = "/root/testdata/sf0.001"
WORDS = "the of and that with stone river light house green idle over under north wind small".split()

# Columns whose names operators use inside.
CLASHING = ["run", "digest", "fp", "salt", "chunk", "key", "id", "score", "shard", "nth", "_gone", "_stays", "label", "lang"]


def make_docs(spark, rows):
    """doc_id and text, with clashing extra columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def odd_rows(seed=1, n=40):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choices(WORDS, k=rng.randint(0, 60)))) for k in range(n)]
    passage = " ".join(rng.choices(WORDS, k=25))
    rows += [(100 + k, f"{' '.join(rng.choices(WORDS, k=5))} {passage} {rng.random()}") for k in range(6)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, rows[3][1]), (204, rows[3][1]), (3, rows[3][1]),
             (None, rows[5][1]), (None, None), (205, "wörter ünd Ünd\u00a0x " * 40), (206, " ".join(rng.choices(WORDS, k=5000)))]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return make_docs(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="module")
def encode_whole():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(default_tokenizer())
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


# Exact dedup.

@pytest.mark.parametrize("largest", [True, False])
def test_exact_classes(odd, none, largest):
    rows = odd_rows()
    got = exact_dedup.exact_classes(odd, largest, fan_in=3).collect()
    assert len(got) == len(rows)
    ids = defaultdict(list)
    for doc, text in rows:
        ids[hashlib.sha256((text or "").encode()).hexdigest()].append(doc)
    stays = Counter()
    for r in got:
        own = ids[r.text_sha256]
        known = [d for d in own if d is not None]
        assert r.group_size == len(own)
        assert r.keep_id == ((max if largest else min)(known) if known else None)
        stays[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(stays.values()) == {1}
    assert exact_dedup.exact_classes(none).collect() == []


def test_drop_copies_keeps_columns(odd, none):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    texts = Counter((r.text or "") for r in kept.collect())
    assert set(texts.values()) == {1} and set(texts) == {t or "" for _, t in odd_rows()}
    assert exact_dedup.drop_copies(none).count() == 0


# Tokens, packing and output.

def test_encoder_equals_whole_text(encode_whole):
    rng, encode = random.Random(2), TextEncoder(default_tokenizer())
    letters = "aZ é́  ß'sd~^|}{🙂\x1c\x85\n\t1٣漢İΣςﬁÅ'llre\u0000_-"
    for k in range(600):
        text = "".join(rng.choices(letters, k=rng.randint(0, 40))) + " <|endoftext|>x" * (k % 10 == 0)
        assert encode(text).tolist() == encode_whole(text), text


class Counting:
    """A tokenizer that counts the words it is given."""

    def __init__(self, tokenizer):
        self._tokenizer, self.words = tokenizer, 0

    def encode(self, text, **options):
        self.words += len(text.split())
        return self._tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.words += sum(len(text.split()) for text in texts)
        return self._tokenizer.encode_batch_fast(texts, **options)


def test_encoder_works_out_a_piece_once(encode_whole):
    encode = TextEncoder(default_tokenizer())
    encode._tokenizer, encode._plain = Counting(encode._tokenizer), Counting(encode._plain)
    forms = [before + word + after for word in ("word", "Word", "WORD", "çà", "Çà") for before in ("", "(", '"') for after in ("", ",", "!!", "-Word", "***", "7")]
    texts = [" ".join(forms), *forms, None, ""]
    assert [ids.tolist() for ids in encode.many(texts)] == [encode_whole(text) for text in texts]
    assert encode._tokenizer.words + encode._plain.words <= len({"word", "çà", "(", '"', ",", "!!", "-", "***", "7"})


def test_corpus_with_ids_of_two_and_four_bytes(spark, odd, encode_whole):
    for end_id in (1, 70_000):
        path = huffman.write_corpus(odd, end_id=end_id, block_tokens=50)
        got = Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in huffman.read_corpus(spark, path).collect())
        assert got == Counter((doc, len(ids), np.array(ids, "<u4").tobytes()) for doc, text in odd_rows() for ids in ([*encode_whole(text), end_id],))


def test_pack(odd, none, encode_whole):
    pieces, placed = packing.pack(odd, max_tokens=64)
    rows = placed.collect()
    want = Counter()
    for doc, text in odd_rows():
        ids = np.array([*encode_whole(text), 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = ids[start:start + 64]
            want[doc, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(at) <= 1.05 * -(-sum(r.length for r in rows) // 64)
    full = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(pieces, placed).collect()}
    assert full == {s: sum(n for _, n in places) for s, places in at.items()}
    assert packing.pack(none)[1].count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {n: rng.randint(1, 50) for n in rng.sample(range(1, 129), 60)}
    made = packing.plan(counts, 128)
    assert all(sum(items) <= 128 for items, _ in made)
    used = Counter()
    for items, times in made:
        for n in items:
            used[n] += times
    assert used == Counter(counts)
    ranges = defaultdict(list)
    for n, first, last, _, _ in packing.slots(made):
        ranges[n].append((first, last))
    for n, spans in ranges.items():
        ends = sorted(spans)
        assert ends[0][0] == 0 and ends[-1][1] == counts[n] and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_exact_complements_come_first():
    assert packing.plan({100: 2, 28: 1, 20: 1, 8: 1}, 128) == [((100, 28), 1), ((100, 20, 8), 1)]


@pytest.mark.parametrize("seed,max_bits", [(0, 18), (1, 9), (2, 8)])
def test_huffman_round_trip(seed, max_bits):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(0.05, 5000) - 1, 199).astype(np.int64)
    counts = np.bincount(ids)
    lengths = huffman.code_lengths(counts, max_bits)
    assert lengths.max() <= max_bits and (lengths[counts == 0] == 0).all()
    assert sum(2.0 ** -n for n in lengths[lengths > 0]) == 1
    stream, bits, stops = huffman.encode_ids(ids, lengths, huffman.canonical(lengths))
    assert bits == int(lengths[ids].sum()) and len(stream) == -(-bits // 8)
    assert (huffman.Decoder(lengths)(stream, stops, len(ids)) == ids).all()


def test_huffman_lengths_are_optimal():
    import heapq

    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1])
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert int((huffman.code_lengths(counts) * counts).sum()) == total
    assert huffman.code_lengths(np.array([0, 7])).tolist() == [0, 1]


def test_token_output(spark, odd, none, encode_whole):
    path = huffman.write_corpus(odd, block_tokens=500)
    rows = sorted(huffman.read_corpus(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d) and len(ids) == len(odd_rows())
    texts = defaultdict(Counter)
    for doc, text in odd_rows():
        texts[doc][np.array([*encode_whole(text), 1], "<u4").tobytes()] += 1
    end = 0
    for r in rows:
        assert r.start == end and texts[r.doc_id][bytes(r.ids)] and len(r.ids) == 4 * r.n_tokens
        end += r.n_tokens
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in huffman.read_corpus(spark, path, digest_only=True).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}
    assert huffman.read_corpus(spark, huffman.write_corpus(none)).count() == 0


# SimHash.

def brute_print(text):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("segments", [2, 4])
def test_near_classes(odd, none, segments):
    rows = odd_rows()
    prints = [brute_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(len(rows)):
            if bin(prints[i] ^ prints[j]).count("1") <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, rows):
        least[g] = doc if least.get(g) is None or doc is not None and doc < least[g] else least[g]
    want = Counter((doc, f"{p:016x}", least[g]) for (doc, _), p, g in zip(rows, prints, group))
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_classes(odd, segments=segments).collect())
    assert got == want
    kept = simhash.drop_near_copies(odd, segments=segments)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {doc for doc, _, c in want if doc is None or doc == c}
    assert simhash.near_classes(none).collect() == [] and simhash.drop_near_copies(none).count() == 0


def test_links_lose_none(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(12)} | {0, 1, 7, 15})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    for segments in (2, 4):
        got = [(r.a, r.b) for r in simhash.links(df, segments=segments).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components(spark):
    chain = [(k, k + 1) for k in range(100, 160)] + [(5, 9), (9, 7), (300, 301), (301, 300), (40, 40)]
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, 5: 5, 7: 5, 9: 5, 300: 300, 301: 300}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


# Substring dedup.

def brute_repeats(rows, window):
    texts = [(doc if doc is not None else 1 << 62, doc, re.findall("[^\x20\x09-\x0D]+", t or "")) for doc, t in rows]
    first = {}
    for rank, _, words in texts:
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            first[key] = min(rank, first.get(key, rank))
    out = Counter()
    for rank, doc, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < rank:
                gone[i:i + window] = [True] * window
        out[doc, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)] += 1
    return out


@pytest.mark.parametrize("window,chunk_bytes", [(13, 1 << 20), (13, 2000), (4, 3000)])
def test_remove_repeats(odd, none, window, chunk_bytes):
    got = substring_dedup.remove_repeats(odd, window, chunk_bytes).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_repeats(odd_rows(), window)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert substring_dedup.remove_repeats(none).collect() == []


def test_deep_nodes_are_equal_suffixes():
    leaves = [b"a b", b"a c", b"a b", b"b a", b"a b"]
    order, node = substring_dedup.deep_nodes(leaves)
    assert [[leaves[i] for i in order[node == k]] for k in range(node[-1] + 1)] == [[b"a b"] * 3, [b"a c"], [b"b a"]]


# Text models.

@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(7)
    docs, labels = [], []
    for k in range(240):
        toxic, good = k % 5 == 0, k % 3 != 0
        words = rng.choices(WORDS, k=40)
        if toxic:
            words.insert(rng.randrange(40), "slurword")
        if not good:
            words = [w.upper() + "!!" for w in words]
        docs.append((k, " ".join(words)))
        labels.append((k, int(good), int(toxic)))
    docs += [(500, None), (501, ""), (502, "slurword"), (None, "the of"), (503, "slurword " * 5000)]
    labels += [(900, 1, 1), (None, 1, 1), (4, None, None)]
    return make_docs(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rule(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


@pytest.mark.parametrize("module,label,threshold", [(toxicity, "toxic", 0.3), (quality, "quality", 0.7)])
def test_text_models(labelled, module, label, threshold):
    docs, labels = labelled
    model = module.fit_on(docs, labels, label)
    rows = docs.select("doc_id", module.score(F.col("text"), model).alias("score"), held_out(F.col("doc_id")).alias("h")).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    tried = [(r.score >= threshold) == truth[r.doc_id] for r in rows if r.h and truth.get(r.doc_id) is not None]
    assert len(tried) > 30 and np.mean(tried) > 0.95
    assert module.fit_on(docs, labels, label, most=50) is not None


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_text_models_without_rows(labelled, none, module, label):
    docs, labels = labelled
    empty = module.fit_on(docs, labels.limit(0), label)
    assert docs.select(module.score(F.col("text"), empty).alias("s")).where("abs(s - 0.5) > 1e-6").count() == 0
    assert none.select(module.score(F.col("text"), empty).alias("s")).count() == 0
    one = module.fit_on(docs, labels.where(f"{label} = 1"), label)
    assert docs.select(module.score(F.col("text"), one).alias("s")).where("s < 0.9").count() == 0


# URLs.

def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def brute_rule(host, path):
    found = None
    for rule, _ in url_filter.RULES:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and len(rule) > len(found or ""):
            found = rule
    return found


def test_urls(spark):
    # Urls of each shape that the rules tell apart.
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x", "https://example.org/en/1", "https://example.org/en/2?x=/en/1",
            "http://b.com/fr/1", "http://b.com/de/#x", "http://b.com?x=/fr/", "http://xcom/fr/", "HTTP://ÄB.net/p", "http://free-bets.example.net/en/5",
            "http://com/de/", "x://y://z.org/", "https://org", "http://cooking.example.net/en/5"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("score", F.lit(1))
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for k, url in enumerate(urls):
        host, path = brute_url(url)
        assert (rows[k].host, rows[k].path, rows[k]["rule"]) == (host, path, brute_rule(host, path)), url
        assert rows[k].verdict == dict(url_filter.RULES).get(rows[k]["rule"], "block" if rows[k].score >= 0.5 else "allow")
    assert rows[12].verdict == "block" and rows[16].verdict == "allow"
    assert url_filter.judge(pages.limit(0)).collect() == []


# Pages.

def page(*inside):
    return f"<html><head><title>t</title><script>x='</p>'</script></head><body>{''.join(inside)}</body></html>"


def test_article_is_kept_whole():
    html = page("<nav><a>Menu</a></nav><div class='ad-box'>Buy</div><article><header><h1>Head &amp; tail</h1></header><p>One\n two<br>three<p>Four",
                "<form><p>mail</p></form><div id=comments><p>Me too</p></div></article><aside>Side</aside><footer>Foot</footer>")
    assert html_text.main_texts([html_text.blocks_of(html)]) == ["Head & tail\nOne two three\nFour"]
    assert html_text.main_texts([html_text.blocks_of(h) for h in (None, "", "<![if x]><p>a<", "<p>&am b &lt c")]) == ["", "", "a\n<", "&am b < c"] \
        or html_text.main_texts([html_text.blocks_of("<p>&am b &lt c")]) == ["&am b < c"]


def test_open_blocks_lose_repeats():
    pages = [page(f"<div>All the news that fits today</div><p>{' '.join(f'w{k}{i}' for i in range(20))}</p><div>Copyright by us</div>") for k in range(3)]
    texts = html_text.main_texts([html_text.blocks_of(p) for p in pages])
    assert texts == [" ".join(f"w{k}{i}" for i in range(20)) for k in range(3)]


def test_repeats_are_counted_over_the_whole_host(spark):
    rows = [(k, "http://a.org/", page(f"<p>{' '.join(f'w{k}x{i}' for i in range(20))}</p><div>Made by all of us for you</div>")) for k in range(257)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()
    assert {r.page_id: r.text for r in got} == {k: " ".join(f"w{k}x{i}" for i in range(20)) for k in range(257)}


def test_shared_words_and_copied_texts_stay():
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(10)]
    texts[3] = texts[3][:59] + " as they said in the end of the day " + texts[3][60:]
    texts[4] = texts[4][:49] + " as they said in the end of the day " + texts[4][50:]
    texts[6] = texts[5]
    foot = "Printed by all of us for every one of you with great care and joy"
    pages = [html_text.blocks_of(page(f"<p>{text}</p><h2>News</h2><div>{foot}</div>")) for text in texts]
    assert html_text.main_texts(pages) == texts


def test_notices_go_from_all_pages_and_copied_stories_stay():
    notice, story = " ".join(f"n{i}" for i in range(40)), " ".join(f"s{i}" for i in range(80))
    own = [f"<p>{' '.join(f'w{k}x{i}' for i in range(15))}</p>" for k in range(10)]
    pages = [html_text.blocks_of(page(own[k], f"<p>{story}</p>" if k < 3 else "", f"<div>{notice}</div>")) for k in range(10)]
    assert html_text.main_texts(pages) == [f"{own[k][3:-4]}" + (f"\n{story}" if k < 3 else "") for k in range(10)]
    assert html_text.main_texts(pages[3:5]) == [own[k][3:-4] for k in (3, 4)]


@pytest.mark.parametrize("inside,text", [
    ("<div class='layout has-sidebar'><article>Body</article></div>", "Body"),
    ("<div class='with-nav search-results'><article>Body</article></div>", "Body"),
    ("<div class='no-comments'><p>Body</p></div>", "Body"),
    ("<div class='widget'><main><p>Body</p></main></div>", "Body"),
    ("<div class='related'><article>Other</article></div><article>Body</article>", "Body"),
    ("<aside><article>Other</article></aside><p>Body</p>", "Body"),
    ("<p class='notice'>Cookies<p>Body<p>More", "Body\nMore"),
    ("<ul><li class='ad'>Buy<li>Body</ul>", "Body"),
    ("<h1>Head</h1><p>Lead</p><article>Body</article>", "Head\nLead\nBody"),
    ("<article>Body<div class='comment-list'>Me</div></article>", "Body"),
    ("<div class='main-nav'>Go</div><p>Body</p>", "Body"),
    *[(f"<article>Body<div {c}>Me</div></article>", "Body") for c in (
        "class='user-comments'", "class='reader-comments'", "class='comment-thread'", "class='post-comment'", "class='related-posts'",
        "class='social-share-buttons'", "class='advert-300x250'", "id='respond'", "style='color:red; display: none'")],
    ("<article>Let <math><mi>x</mi></math> be <svg><title>t</title><text>drawn</text></svg> <object>so</object></article>", "Let x be drawn so"),
])
def test_markup_keeps_the_text(inside, text):
    assert html_text.main_texts([html_text.blocks_of(page(inside))]) == [text]


def brute_main_texts(pages, least):
    """Texts of pages of one host, by comparing every window of words with every page."""
    def windows(words):
        return [tuple(words[k:k + least]) for k in range(max(1, len(words) - least + 1))]

    open_ = [[t.split(" ") for z, t in blocks if z == "open"] for blocks in pages]
    on = {}
    for p, blocks in enumerate(open_):
        for words in blocks:
            for w in windows(words):
                on.setdefault(w, set()).add(p)
    texts = []
    for blocks in pages:
        kept, every = [], []
        for zone, text in blocks:
            if zone == "chrome":
                continue
            every.append(text)
            words = text.split(" ")
            gone = set()
            for k, w in enumerate(windows(words) if zone == "open" else ()):
                if len(on[w]) >= 2 and 2 * len(on[w]) > len(pages):
                    gone |= set(range(k, k + len(w)))
            kept += [" ".join(w for k, w in enumerate(words) if k not in gone)] if len(gone) < len(words) else []
        texts.append("\n".join(kept or every))
    return texts


@pytest.mark.parametrize("part_words", [30, 500_000])
def test_extract_against_brute_force(spark, part_words):
    rng = random.Random(3)
    rows, want = [], {}
    for host, n in (("two", 2), ("three", 3), ("some", 40), ("many", 300)):
        common = [" ".join(rng.choices("abcd", k=rng.randint(1, 30))) for _ in range(4)]
        htmls = set()
        while len(htmls) < n:
            own = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 12))) for _ in range(rng.randint(0, 2))]
            blocks = own + [c for c in common if rng.random() < 0.6]
            rng.shuffle(blocks)
            htmls.add(page(*[f"<p>{b}</p>" for b in blocks], f"<article>a {len(htmls)}</article>" if rng.random() < 0.3 else ""))
        htmls = sorted(htmls)
        for html, text in zip(htmls, brute_main_texts([html_text.blocks_of(h) for h in htmls], 4)):
            for _ in range(1 + 5 * (html == htmls[0])):
                want[len(rows)] = text
                rows.append((len(rows), f"http://{host}.org/{len(rows)}", html))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, 4, part_words).collect()}
    assert got == want


def test_extract(spark):
    rows = [(1, "http://a.org/1", page("<article><p>One</p></article>")), (2, None, None), (3, "http://a.org/3", ""),
            (4, "http://b.org/", page("<p>Alone on its host</p>")), (4, "http://b.org/", page("<main>x" + " y" * 100_000 + "</main>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("blocks", F.lit(1)).withColumn("host", F.lit("h"))
    got = sorted((r.page_id, r.text[:5], r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [(1, "One", 3), (2, "", 0), (3, "", 0), (4, "Alone", 17), (4, "x y y", 200_001)]
    assert html_text.extract(pages.limit(0)).count() == 0


# Decontamination.

def edited(words, edits, rng, voc):
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out) + 1), rng.randrange(3)
        if kind == 0:
            out.insert(at, rng.choice(voc))
        elif at < len(out):
            out[at:at + 1] = [rng.choice(voc)] if kind == 1 else []
    return out


def brute_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        nxt = [i]
        for j, y in enumerate(words, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return min(row)


def test_matches_find_edited_items(spark):
    rng = random.Random(9)
    voc = [f"{a}{b}" for a in WORDS for b in "abcdefgh"]
    items = [(k, " ".join(rng.choices(voc, k=rng.randint(15, 60)))) for k in range(40)] + [(90, None), (91, ""), (92, "one two")]
    docs = []
    for k, text in items[:40]:
        words = text.split()
        for share in (0, 0.1, 0.2, 0.5):
            body = edited(words, int(share * len(words)), rng, voc)
            docs.append((len(docs), " ".join(rng.choices(voc, k=30) + body + rng.choices(voc, k=30)).title()))
    docs += [(900, None), (901, ""), (902, "one two three"), (None, items[0][1]), (903, items[0][1]), (903, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    df = make_docs(spark, docs)
    got = Counter((r.doc_id, r.item_id, r.edit_distance) for r in decontaminate.matches(df, bench).collect())
    want = Counter()
    for doc, text in docs:
        words = decontaminate.words_of(text)
        for item, passage in items:
            own = decontaminate.words_of(passage)
            if own and words and (d := brute_distance(own, words)) <= int(0.2 * len(own) + 1e-9):
                want[doc, item, d] += 1
    assert not got - want
    assert sum((want & got).values()) >= 0.97 * sum(want.values())
    sliced = Counter((r.doc_id, r.item_id, r.edit_distance) for r in decontaminate.matches(df, bench, slice_bytes=3000).collect())
    assert not sliced - want and sum(sliced.values()) >= 0.97 * sum(want.values())
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()}.isdisjoint({d for d, _, _ in got}) and kept.count() == len(docs) - len(list(
        {i for i, (doc, _) in enumerate(docs) if any(g[0] == doc for g in got)}))
    assert decontaminate.matches(df.limit(0), bench).count() == 0
    assert decontaminate.matches(df, bench.limit(0)).count() == 0 and decontaminate.drop_contaminated(df, bench.limit(0)).count() == len(docs)
