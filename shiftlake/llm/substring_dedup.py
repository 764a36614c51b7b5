"""Repeated passages across documents, by suffix trees partitioned by variable-length prefixes.

A suffix starts at a word; only its first ``window`` words matter. Documents are
dealt into chunks by a hash of their id, and three passes over the chunks share
one shuffle of the texts:

1. Every window is named by the smallest hash of its short word runs, so equal
   windows have equal names. Names that two chunks hold come back to them; all
   other windows occur in one chunk only.
2. Suffixes with a shared name go, once per chunk, to the group of their
   prefix: the shortest run of first words that holds ``PREFIX_LETTERS``
   letters, so common words give longer prefixes and groups stay of a size. A
   group sorts its suffixes: the sorted list with the common lengths of its
   neighbours is the subtree below the prefixes, and its nodes of depth
   ``window`` are the repeats. A node gives the smallest doc_id of its leaves.
3. A chunk marks its windows whose sequence starts in a smaller document.

Copies of whole texts are found by digest first: they are covered whole by the
smallest copy and send no suffixes. However many documents share a passage, a
chunk sends it once, and a node holds at most one leaf per chunk.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.staging import staged
from shiftlake.llm.wordtable import _Index

WINDOW = 13
PREFIX_LETTERS = 24
CHUNK_BYTES = 4 << 20
GROUP_BYTES = 16 << 20
NAME_BYTES = 256 << 20
SALTS = 64
LAST = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _rolled(line: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit value of every run of ``size`` words."""
    room = max(0, len(line) - size + 1)
    value = np.zeros(room, np.uint64)
    for k in range(size):
        value = (value ^ line[k:k + room]) * _ODD
        value ^= value >> np.uint64(32)
    return value * _MIX


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class _Chunk:
    """Words and windows of the documents of a chunk that are no copies."""

    def __init__(self, docs: pa.Table, copies: set[tuple[int, int]], window: int):
        self.window = window
        order = np.argsort(np.array(docs["id"]), kind="stable") if docs.num_rows else []
        ids, keys, texts = docs["id"].to_pylist(), docs["key"].to_pylist(), docs["text"]
        self.rows, self.words, self.bounds = [], [], []
        for row in order:
            row = int(row)
            if (ids[row], keys[row]) not in copies:
                own = texts[row].as_py().encode().split()
                self.rows.append(row)
                self.bounds.append((len(self.words), len(self.words) + len(own)))
                self.words += own
        index = _Index()
        codes = np.fromiter(map(index.__getitem__, self.words), np.int64, len(self.words))
        self.line = _word_hashes(index.new)[codes] if index.new else np.zeros(0, np.uint64)
        self.ids = np.repeat(np.array([ids[r] for r in self.rows], np.int64), [b - a for a, b in self.bounds]) \
            if self.rows else np.zeros(0, np.int64)
        room = max(0, len(self.words) - window + 1)
        inside = np.zeros(room, bool)
        for a, b in self.bounds:
            inside[a:max(a, b - window + 1)] = True
        self.at = np.flatnonzero(inside)

    def names(self) -> np.ndarray:
        """For each window the least value of its runs of a few words."""
        size = max(1, self.window * 2 // 5)
        runs = _rolled(self.line, size)
        span = self.window - size + 1
        room = max(0, len(runs) - span + 1)
        least = runs[:room].copy()
        for k in range(1, span):
            np.minimum(least, runs[k:k + room], out=least)
        return least[self.at]

    def local_names(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct names, whether two documents of the chunk hold it)."""
        names, ids = self.names(), self.ids[self.at]
        if not len(names):
            return names, np.zeros(0, bool)
        first = np.concatenate([[True], (names[1:] != names[:-1]) | (ids[1:] != ids[:-1])])
        names, ids = names[first], ids[first]
        order = np.lexsort((ids, names))
        names, ids = names[order], ids[order]
        start = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        last = np.append(start[1:], len(names)) - 1
        return names[start], ids[start] != ids[last]

    def classes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, position) of the distinct windows that start at ``at``, each at its smallest document."""
        values = _rolled(self.line, self.window)[at]
        order = np.lexsort((at, values))
        values, at = values[order], at[order]
        first = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
        return values[first], at[first]

    def groups(self, at: np.ndarray, count: int) -> np.ndarray:
        """Group of the prefix of each suffix."""
        letters = np.concatenate([[0], np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)))])
        ends = np.searchsorted(letters, letters[at] + PREFIX_LETTERS)
        value = np.zeros(len(at), np.uint64)
        for k in range(self.window):
            grown = (value ^ self.line[at + k]) * _ODD
            value = np.where((k == 0) | (at + k < ends), grown ^ (grown >> np.uint64(32)), value)
        return ((value * _MIX) >> np.uint64(33)).astype(np.int64) % count


def _copies(side: pa.Table) -> set[tuple[int, int]]:
    found = set()
    for ids, keys in zip(side["copy_ids"], side["copy_keys"]):
        if ids.is_valid:
            found.update(zip(ids.values.to_pylist(), keys.values.to_pylist()))
    return found


def _packed(side: pa.Table, column: str, dtype) -> np.ndarray:
    parts = [np.frombuffer(b.as_py(), dtype) for b in side[column] if b.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _zip(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _unzip(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


NAMES = "bucket int, chunk int, names binary"
SHARED = "chunk int, copy_ids array<long>, copy_keys array<long>, names binary, values binary, least binary"
SUFFIXES = "grp int, chunk int, size int, texts binary, ids binary"
KEPT = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:long,end:long>>"
_SHARED_TYPES = {"chunk": pa.int32(), "copy_ids": pa.list_(pa.int64()), "copy_keys": pa.list_(pa.int64()),
                 "names": pa.binary(), "values": pa.binary(), "least": pa.binary()}


def _shared_table(**columns) -> pa.Table:
    n = len(columns["chunk"])
    return pa.table({name: pa.array(columns.get(name, [None] * n), kind) for name, kind in _SHARED_TYPES.items()})


def _chunk_no(side: pa.Table, docs: pa.Table) -> int:
    return (docs if docs.num_rows else side)["chunk"][0].as_py()


def send_names(window: int, buckets: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        names, _ = _Chunk(docs, _copies(side), window).local_names()
        bucket = (names >> np.uint64(40)).astype(np.int64) * buckets >> 24
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [(k, names[a:b].tobytes()) for k, (a, b) in enumerate(pairwise(cuts)) if b > a]
        return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int32()),
                         "chunk": pa.array([_chunk_no(side, docs)] * len(rows), pa.int32()),
                         "names": pa.array([b for _, b in rows], pa.binary())})
    return run


def shared_names(table: pa.Table) -> pa.Table:
    """Names that two chunks hold, back to each of them."""
    parts = [np.frombuffer(b.as_py(), np.uint64) for b in table["names"]]
    names = np.concatenate(parts)
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    shared = np.zeros(len(names), bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    rows = [(table["chunk"][k].as_py(), names[a:b][shared[a:b]]) for k, (a, b) in enumerate(pairwise(cuts))]
    rows = [(c, found.tobytes()) for c, found in rows if len(found)]
    return _shared_table(chunk=[c for c, _ in rows], names=[b for _, b in rows])


def send_suffixes(window: int, groups: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, _copies(side), window)
        own, twice = chunk.local_names()
        wanted = np.union1d(own[twice], _packed(side, "names", np.uint64))
        _, at = chunk.classes(chunk.at[np.isin(chunk.names(), wanted)])
        at = np.sort(at)
        group = chunk.groups(at, groups) if len(at) else at
        order = np.argsort(group, kind="stable")
        at, group = at[order], group[order]
        cuts = np.searchsorted(group, np.arange(groups + 1))
        rows, words = [], chunk.words
        for k, (a, b) in enumerate(pairwise(cuts)):
            if b > a:
                texts = b"\n".join([b" ".join(words[p:p + window]) for p in at[a:b].tolist()])
                rows.append((k, len(texts), _zip(texts), _zip(chunk.ids[at[a:b]].tobytes())))
        number = _chunk_no(side, docs)
        return pa.table({"grp": pa.array([r[0] for r in rows], pa.int32()), "chunk": pa.array([number] * len(rows), pa.int32()),
                         "size": pa.array([r[1] for r in rows], pa.int32()), "texts": pa.array([r[2] for r in rows], pa.binary()),
                         "ids": pa.array([r[3] for r in rows], pa.binary())})
    return run


def deep_nodes(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order of the leaves, node of each leaf in that order).

    Suffixes are cut at the depth asked for, so leaves whose neighbours in
    order agree throughout hang below one node of that depth.
    """
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    new = np.fromiter((suffixes[a] != suffixes[b] for a, b in pairwise(order)), bool, max(0, len(order) - 1))
    return np.array(order, np.int64), np.concatenate([[0], np.cumsum(new)])


def grow_subtrees(window: int):
    def run(table: pa.Table) -> pa.Table:
        suffixes, ids, row = [], [], []
        for k in range(table.num_rows):
            texts = _unzip(table["texts"][k].as_py(), table["size"][k].as_py()).split(b"\n")
            suffixes += texts
            ids.append(np.frombuffer(_unzip(table["ids"][k].as_py(), 8 * len(texts)), np.int64))
            row += [k] * len(texts)
        order, node = deep_nodes(suffixes)
        ids, row = np.concatenate(ids)[order], np.array(row)[order]
        least = np.minimum.reduceat(ids, np.flatnonzero(np.diff(node, prepend=-1)))[node]
        late = np.flatnonzero(ids > least)
        index = _Index()
        codes = np.fromiter((index[w] for i in order[late].tolist() for w in suffixes[i].split(b" ")), np.int64)
        value = np.zeros(len(late), np.uint64)
        if len(late):
            hashes = _word_hashes(index.new)[codes].reshape(-1, window)
            for k in range(window):
                value = (value ^ hashes[:, k]) * _ODD
                value ^= value >> np.uint64(32)
            value = value * _MIX
        row, least = row[late], least[late]
        by = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[by], np.arange(table.num_rows + 1))
        rows = [(table["chunk"][k].as_py(), value[by[a:b]].tobytes(), least[by[a:b]].tobytes())
                for k, (a, b) in enumerate(pairwise(cuts)) if b > a]
        return _shared_table(chunk=[r[0] for r in rows], values=[r[1] for r in rows], least=[r[2] for r in rows])
    return run


def cover(window: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        copies = _copies(side)
        chunk = _Chunk(docs, copies, window)
        values, least = _packed(side, "values", np.uint64), _packed(side, "least", np.int64)
        covered = np.zeros(len(chunk.words) + 1, np.int64)
        if len(chunk.at):
            here, at = _rolled(chunk.line, window)[chunk.at], chunk.at
            order = np.argsort(here, kind="stable")
            ranked = here[order]
            start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            first = np.minimum.reduceat(chunk.ids[at][order], start)
            if len(values):
                # Classes met in several groups or places: the smallest document counts.
                place = np.minimum(np.searchsorted(ranked[start], values), len(start) - 1)
                known = ranked[start][place] == values
                np.minimum.at(first, place[known], least[known])
            smallest = np.repeat(first, np.diff(np.append(start, len(ranked))))
            gone = at[order][chunk.ids[at][order] > smallest]
            np.add.at(covered, gone, 1)
            np.add.at(covered, np.minimum(gone + window, len(chunk.words)), -1)
        removed = np.cumsum(covered)[:-1] > 0
        out = []
        for row, (a, b) in zip(chunk.rows, chunk.bounds):
            gone = removed[a:b]
            text = b" ".join([w for w, g in zip(chunk.words[a:b], gone.tolist()) if not g] if gone.any() else chunk.words[a:b])
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            out.append((docs["doc_id"][row].as_py(), b - a, int(gone.sum()), text.decode(),
                        [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]))
        own = set(chunk.rows)
        for row in range(docs.num_rows):
            if row not in own:
                words = docs["text"][row].as_py().encode().split()
                n = len(words)
                whole = n >= window
                out.append((docs["doc_id"][row].as_py(), n, n if whole else 0, "" if whole else b" ".join(words).decode(),
                            [{"start": 0, "end": n}] if whole else []))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                        names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (kept words joined by a space), spans (removed words).

    Words are parted by ASCII white space. A word goes if a window that covers
    it also starts in a document with a smaller doc_id. A null text has no
    words; texts shorter than the window lose none. Rows that repeat a doc_id
    are one document: neither is smaller. A null doc_id is larger than all
    others. Extra columns are not read; no rows give no rows. Within a chunk
    windows are compared by 64-bit values, between chunks by their words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = int(total // chunk_bytes) + 1
    buckets = 1 << max(6, int(total // NAME_BYTES).bit_length())
    groups = 1 << max(5, int(total // GROUP_BYTES).bit_length())
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    number = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ident.alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    dealt = rows.select(number.alias("chunk"), "doc_id", "id", "key", "text")

    digests = staged(rows.select("id", "key", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest")), "digests")
    # A text that a third of all rows share is reduced per salt first, and looked up per salt last.
    digests = digests.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    shares = digests.groupBy("salt", "digest").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    several = shares.groupBy("digest").agg(F.min("least").alias("least"), F.sum("n").alias("n")).where("n > 1").drop("n")
    lookup = shares.select("salt", "digest").join(several, "digest")
    copies = staged(digests.join(lookup, ["salt", "digest"]).where("id > least").groupBy(number.alias("chunk")).agg(
        F.collect_list("id").alias("copy_ids"), F.collect_list("key").alias("copy_keys")), "copies")
    nothing = F.lit(None).cast("binary")
    side = copies.select("chunk", "copy_ids", "copy_keys", nothing.alias("names"), nothing.alias("values"), nothing.alias("least"))

    def over_chunks(known, fn, schema):
        return dealt.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(fn, schema)

    named = over_chunks(side, send_names(window, buckets), NAMES)
    shared = named.groupBy("bucket").applyInArrow(shared_names, SHARED)
    suffixes = over_chunks(side.unionByName(shared), send_suffixes(window, groups), SUFFIXES)
    repeats = suffixes.groupBy("grp").applyInArrow(grow_subtrees(window), SHARED)
    return over_chunks(side.unionByName(repeats), cover(window), KEPT)
