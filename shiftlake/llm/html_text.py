"""Main text of web pages: markup decides where it can, repeats across a host's pages decide the rest.

A page becomes a list of blocks, each in a zone: inside the article, chrome
(menus, headers, footers, adverts, forms ...) or open, where markup tells
nothing. Article blocks are kept whole, chrome goes. Open blocks, also those
beside an article, lose what repeats on the host: their words are concatenated
and a suffix array groups equal runs of them. A large host is dealt over parts
of bounded size, an array each; runs that the parts have in common are found by
their names and confirmed by their words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from shiftlake.llm.salted import lookup, salt_of, salts_for
from shiftlake.llm.staging import staged
from shiftlake.llm.url_filter import host_of

#: Words of a run that counts as long; share of the host's different pages that boilerplate stands on more than.
LEAST_RUN = 12
LEAST_SHARE = 0.5
#: Words of one suffix array.
PART_WORDS = 500_000

ARTICLE, OPEN, CHROME = "article", "open", "chrome"
#: An article inside elements that are chrome by their names only.
WRAPPED = "wrapped"

# Tag and attribute names with a fixed meaning.
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "iframe", "canvas"}
CHROME_TAGS = {"nav", "footer", "aside", "form", "button", "select", "option", "textarea", "dialog", "menu", "label", "input"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend",
          "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CHROME_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar",
                "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "cookie", "cookies", "consent",
                "notice", "gdpr", "popup", "modal", "comment", "comments", "disqus", "reply", "replies", "share", "sharing", "social",
                "related", "recommended", "newsletter", "subscribe", "signup", "login", "search", "pagination", "pager", "widget", "respond"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog"}
#: Parts that a chrome name may stand with in one class: ad-box, main-nav.
NAME_PARTS = {"bar", "body", "bottom", "box", "container", "content", "global", "header", "inner", "item", "items", "left", "link", "links",
              "list", "main", "page", "primary", "right", "secondary", "section", "site", "slot", "top", "unit", "wrap", "wrapper"}
#: Start tags that end an open p; elements that end by the start of a like one, and where the search for them stops.
ENDS_P = BLOCKS - {"body", "caption", "dd", "dt", "html", "legend", "li", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Parts by which a class tells what a page lacks or how it is laid out: no-comments, has-sidebar, search-results.
TELLING = {"no", "non", "not", "with", "without", "has", "have", "is", "results", "layout"}
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
_PARTS = re.compile(r"[-_]+")
_SPACE = re.compile(r"\s+")
_MARKED = re.compile(r"<!\[[^>]*>")


def _named(value: str, names: set[str]) -> bool:
    """Whether a class or id begins or ends with one of ``names``, or holds one among parts that only place it."""
    for token in value.split():
        parts = [q for p in _PARTS.split(token) if (q := p.rstrip("0123456789")) and not re.fullmatch(r"\d+x", q)]
        if not parts or TELLING & set(parts):
            continue
        if {parts[0], parts[-1]} & names or set(parts) & names and set(parts) <= names | NAME_PARTS:
            return True
    return False


class _Blocks(HTMLParser):
    """Collects (zone, text) of every block with text, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self._open: list[tuple[str, bool, bool, bool]] = []
        self._hidden = self._chrome = self._article = 0
        self._text: list[str] = []

    def _end_block(self):
        if self._text:
            if text := _SPACE.sub(" ", "".join(self._text)).strip():
                zone = self._zone()
                self.found.append((zone, text))
            self._text = []

    def _zone(self) -> str:
        if not self._chrome:
            return ARTICLE if self._article else OPEN
        # Names of wrappers around the outermost article do not count against it at once.
        wrapped = False
        for tag, _, chrome, article in self._open:
            if article and not chrome:
                wrapped = True
            elif chrome and (wrapped or tag not in ("div", "section", "body", "html")):
                return CHROME
        return WRAPPED if wrapped else CHROME

    def _end_implied(self, tag: str):
        """Close what the start of ``tag`` ends: an open p, the li before."""
        for ends, within in (({"p"}, {"td", "th", "caption", "table", "button", "object"}) if tag in ENDS_P else (set(), set()), ENDS.get(tag, (set(), set()))):
            for k in range(len(self._open) - 1, -1, -1) if ends else ():
                if self._open[k][0] in ends:
                    self._close_all(self._open[k][0])
                    break
                if self._open[k][0] in within:
                    break

    def _is_chrome(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in CHROME_TAGS or tag == "header" and not self._article:
            return True
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or name == "style" and _UNSEEN.search(value) or name == "aria-hidden" and value == "true" or name == "role" and value in CHROME_ROLES:
                return True
            if name in ("class", "id") and tag not in ("html", "body", "article", "main") and _named(value, CHROME_NAMES):
                return True
            if name in ("class", "id") and tag == "article" and _named(value, {"comment", "reply", "ad", "promo"}):
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_block()
        elif tag == "br":
            self._text.append(" ")
        self._end_implied(tag)
        if tag in VOID:
            return
        hidden, chrome = tag in HIDDEN, self._is_chrome(tag, attrs)
        article = tag in ("article", "main")
        if tag == "body":
            # A head that was never closed ends here.
            self._close_all("head")
        self._open.append((tag, hidden, chrome, article))
        self._hidden, self._chrome, self._article = self._hidden + hidden, self._chrome + chrome, self._article + article

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_block()
        elif tag == "br":
            self._text.append(" ")

    def _close_all(self, tag: str):
        if any(t == tag for t, *_ in self._open):
            while self._open:
                name, hidden, chrome, article = self._open.pop()
                self._hidden, self._chrome, self._article = self._hidden - hidden, self._chrome - chrome, self._article - article
                if name == tag:
                    break

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_block()
        # A stray end tag closes nothing beyond the block that holds it.
        if tag in VOID:
            return
        if tag not in BLOCKS:
            for k in range(len(self._open) - 1, -1, -1):
                if self._open[k][0] == tag:
                    break
                if self._open[k][0] in BLOCKS - {"p"}:
                    return
        self._close_all(tag)

    def handle_data(self, data):
        if not self._hidden:
            self._text.append(data)

    def close(self):
        super().close()
        self._end_block()


def blocks_of(html: str | None) -> list[tuple[str, str]]:
    """(zone, text) per block. An article in a wrapper with a chrome name counts if the page has no other."""
    parser = _Blocks()
    # To browsers a marked section is a comment; to this parser an unknown one is an error.
    parser.feed(_MARKED.sub("", html or ""))
    parser.close()
    wrapped = CHROME if any(zone == ARTICLE for zone, _ in parser.found) else ARTICLE
    return [(wrapped if zone == WRAPPED else zone, text) for zone, text in parser.found]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the ``depth`` codes that follow, by prefix doubling."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    n, step = len(codes), 1
    while step < depth:
        ahead = np.full(n, -1, np.int64)
        ahead[:max(0, n - step)] = rank[step:]
        both = rank * (n + 2) + ahead + 1
        rank = np.unique(both, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


class Runs:
    """All runs of ``least`` words of the open blocks of some pages, equal ones in one group.

    ``pages`` has a list of blocks per page, a block being its words. No run
    crosses a block; a block of fewer words is a run by itself.
    """

    def __init__(self, pages: list[list[list[str]]], least: int):
        self._pages, self._least = pages, least
        codes: dict[str, int] = {}
        line, page, mark = [], [], -1
        for p, blocks in enumerate(pages):
            for words in blocks:
                # A short block is filled up with a common mark; marks that never repeat end a block.
                line += [codes.setdefault(w, len(codes)) for w in words]
                pad = max(0, least - len(words))
                mark -= 1
                line += [-1] * pad + [mark]
                page += [p] * (len(words) + pad + 1)
        self._words = list(codes)
        self._text = text = np.array(line, np.int64)
        n = len(text)
        self._group = np.full(n, -1, np.int64)
        self._first, self.on = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # The mark that ends the block of each place.
        end = np.minimum.accumulate(np.where(text < -1, np.arange(n), n)[::-1])[::-1]
        order = suffix_array(text, least) if n else np.zeros(0, np.int64)
        order = order[(text[order] >= 0) & (order + least <= end[order])]
        if not len(order):
            return
        # Neighbours in the array share a run if their first ``least`` codes agree.
        same = np.ones(len(order) - 1, bool)
        for k in range(least):
            same &= text[order[:-1] + k] == text[order[1:] + k]
        group = np.concatenate([[0], np.cumsum(~same)])
        self._group[order] = group
        self._first = order[np.concatenate([[True], ~same])]
        held = np.unique(group * len(pages) + np.array(page, np.int64)[order])
        #: On how many of the pages the run of each group stands.
        self.on = np.bincount(held // len(pages), minlength=len(self._first))

    def words(self, group: int) -> str:
        at = self._first[group]
        return " ".join(self._words[c] for c in self._text[at:at + self._least] if c >= 0)

    def name(self, group: int) -> int:
        return xxhash.xxh64_intdigest(self.words(group).encode("utf-8", "surrogatepass")) - (1 << 63)

    def covered(self, repeats: set[str]) -> list[list[np.ndarray]]:
        """For the blocks of each page, which words lie in a run of ``repeats``."""
        goes = np.array([self.words(g) in repeats for g in range(len(self.on))] + [False], bool)
        starts = np.flatnonzero(goes[self._group])
        cover = np.zeros(len(self._text) + self._least + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + self._least, -1)
        inside = np.cumsum(cover) > 0
        out, at = [], 0
        for blocks in self._pages:
            marks = []
            for words in blocks:
                marks.append(inside[at:at + len(words)])
                at += max(len(words), self._least) + 1
            out.append(marks)
        return out


Blocks = list[tuple[str, str]]


def runs_of(pages: list[Blocks], least: int = LEAST_RUN) -> Runs:
    return Runs([[text.split(" ") for zone, text in blocks if zone == OPEN] for blocks in pages], least)


def main_text(blocks: Blocks, covered: list[np.ndarray]) -> str:
    """The page's article and open blocks without the covered words of the latter."""
    marks, kept, every = iter(covered), [], []
    for zone, text in blocks:
        if zone == CHROME:
            continue
        every.append(text)
        if zone == OPEN:
            text = " ".join(w for w, c in zip(text.split(" "), next(marks)) if not c)
        if text:
            kept.append(text)
    # A page of nothing but repeats is made of others: its text is not only theirs.
    return "\n".join(kept or every)


def fewest_pages(pages: int) -> int:
    """On how many of a host's different pages boilerplate stands at least."""
    return max(2, math.floor(LEAST_SHARE * pages) + 1)


def main_texts(pages: list[Blocks], least: int = LEAST_RUN) -> list[str]:
    """Main texts of the different pages of one host, given their blocks."""
    runs = runs_of(pages, least)
    repeats = {runs.words(g) for g in np.flatnonzero(runs.on >= fewest_pages(len(pages)))}
    return [main_text(blocks, marks) for blocks, marks in zip(pages, runs.covered(repeats))]


def _blocks_in(table: pa.Table) -> list[Blocks]:
    return [[(b["zone"], b["text"]) for b in blocks] for blocks in table.column("blocks").to_pylist()]


def _per_part(parts: DataFrame, of_host: DataFrame) -> GroupedData:
    """The rows of each host once for every part of it."""
    held = parts.select(F.col("host").alias("of"), F.col("part").alias("of_part")).distinct()
    return held.join(of_host, F.col("of") == F.col("host")).drop("host").groupBy("of", "of_part")


def _repeats(parts: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """(host, words) of the runs that stand on enough of the host's pages."""
    def named(key: tuple, table: pa.Table) -> pa.Table:
        runs = runs_of(_blocks_in(table), least)
        n = len(runs.on)
        return pa.table({"host": pa.array([key[0].as_py()] * n, pa.string()), "name": pa.array([runs.name(g) for g in range(n)], pa.int64()),
                         "on": pa.array(runs.on, pa.int64())})

    def spelled(key: tuple, table: pa.Table, wanted: pa.Table) -> pa.Table:
        names = set(wanted.column("name").to_pylist())
        runs = runs_of(_blocks_in(table), least)
        groups = [g for g in range(len(runs.on)) if runs.name(g) in names]
        return pa.table({"host": pa.array([key[0].as_py()] * len(groups), pa.string()), "words": pa.array([runs.words(g) for g in groups], pa.string()),
                         "on": pa.array([int(runs.on[g]) for g in groups], pa.int64())})

    def enough(found: DataFrame, key: str) -> DataFrame:
        # At most two of a page's average runs per host: a run stands on more than half of its pages.
        total = found.groupBy("host", key).agg(F.sum("on").alias("on")).where(F.col("on") >= 2)
        return total.join(sizes, "host").where((F.col("on") > F.lit(LEAST_SHARE) * F.col("pages"))).select("host", key)

    names = staged(enough(parts.groupBy("host", "part").applyInArrow(named, "host string, name long, on long"), "name"), "names")
    met = parts.groupBy("host", "part").cogroup(_per_part(parts, names)).applyInArrow(spelled, "host string, words string, on long")
    return staged(enough(met, "words"), "repeats")


def extract(pages: DataFrame, least: int = LEAST_RUN, part_words: int = PART_WORDS) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    A null or empty page has the empty text. Rows of a host with equal markup
    are one page where repeats are counted, and each has its text; a null url
    is a host of its own name. Boilerplate in open blocks are runs of ``least``
    words, and whole shorter blocks, on two or more and over half of the host's
    different pages. Extra columns are not read; no rows give no rows.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, blocks, words = [], [], []
            for html in batch.column("html"):
                own = [(z, t) for z, t in blocks_of(html.as_py()) if z != CHROME]
                open_ = [t for z, t in own if z == OPEN]
                texts.append(None if open_ else main_text(own, []))
                blocks.append([{"zone": z, "text": t} for z, t in own] if open_ else None)
                words.append(sum(t.count(" ") + 1 for t in open_))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "host", "page")), pa.array(texts, pa.string()),
                 pa.array(blocks, pa.list_(pa.struct([("zone", pa.string()), ("text", pa.string())]))), pa.array(words, pa.int64())],
                names=["page_id", "url", "host", "page", "text", "blocks", "words"])

    def finish(key: tuple, table: pa.Table, repeats: pa.Table) -> pa.Table:
        own = _blocks_in(table)
        marks = runs_of(own, least).covered(set(repeats.column("words").to_pylist()))
        return pa.table({"page": table.column("page"), "found": pa.array([main_text(b, m) for b, m in zip(own, marks)], pa.string())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"))
    rows = rows.withColumn("page", F.sha2(F.concat_ws("\n", "host", "html"), 256))
    parsed = staged(rows.mapInArrow(parse, "page_id long, url string, host string, page string, text string, "
                                           "blocks array<struct<zone:string,text:string>>, words long"), "blocks")
    sizes = parsed.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    different = parsed.where("blocks is not null").select("host", "page", "words", "blocks").dropDuplicates(["page"])
    counts = parsed.where("blocks is not null").select("host", "page", "words").distinct().groupBy("host").agg(
        F.ceil(F.sum("words") / part_words).alias("parts"))
    parts = staged(different.join(counts, "host").select("host", "page", "blocks", F.pmod(F.xxhash64("page"), "parts").alias("part")), "parts")
    repeats = _repeats(parts, sizes, least)
    found = parts.groupBy("host", "part").cogroup(_per_part(parts, repeats)).applyInArrow(finish, "page string, found string")
    salts = salts_for(parsed.count())
    open_ = parsed.where("blocks is not null").select("page_id", "url", "page", salt_of(F.col("page_id"), salts=salts).alias("salt"))
    open_ = lookup(open_, found, "page", "salt").select("page_id", "url", F.col("found").alias("text"))
    return parsed.where("blocks is null").select("page_id", "url", "text").unionByName(open_).withColumn("n_chars", F.length("text").cast("long"))
