"""Token ids of whole texts, by a public tokenizer file."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shiftlake.llm.wordtable import WordTable

# str.split() also breaks at these four separators, which the tokenizer keeps as characters.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Characters of texts whose words are looked up in one go.
CHARS_AT_ONCE = 1 << 21
#: Texts that are held for it, however short.
TEXTS_AT_ONCE = 20_000

# Single characters that no other character normalises to; one that is absent from the words parts them.
_SENTINELS = "~^|}{"
# How the vocabulary writes the end of a word.
_WORD_END = "</w>"

# Kinds of characters: the splitting pattern makes runs of letters, runs of marks and single digits pieces of their own.
# No rule joins these marks with letters, as it does the apostrophe, and no special token holds one.
_SPACE, _LETTER, _MARK, _DIGIT, _OTHER = range(5)
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def _kinds() -> np.ndarray:
    """The kind of each code point of Latin-1; the last entry is for all others."""
    kinds = np.full(257, _OTHER, np.int8)
    for code in range(256):
        char = chr(code)
        if char.isalpha():
            kinds[code] = _LETTER
        elif char in _MARKS:
            kinds[code] = _MARK
        elif char in "0123456789":
            kinds[code] = _DIGIT
    kinds[ord(" ")] = _SPACE
    return kinds


_KINDS = _kinds()
# Letters of Latin-1 stay in it, one for one.
_LOWER = np.array([ord(chr(code).lower()) for code in range(256)], np.uint32)


def _distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the distinct words, which of them each word is)"""
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


def _pieces(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces of the plain words in turn, in lower case; pieces per word; which words have other characters)."""
    line, = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(" ", pa.large_string())).to_pylist()
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    kinds = _KINDS[np.minimum(codes, 256)]
    owner = np.cumsum(kinds == _SPACE)
    odd = np.zeros(len(words), bool)
    odd[owner[kinds == _OTHER]] = True
    plain = ~odd[owner]
    codes, kinds, owner = codes[plain], kinds[plain], owner[plain]
    shown = kinds != _SPACE
    codes, kinds, owner = _LOWER[codes[shown]], kinds[shown], owner[shown]
    begins = np.ones(len(kinds), bool)
    begins[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(begins)
    counts = np.bincount(owner[begins], minlength=len(words))
    if not len(begins):
        return pa.array([], pa.large_string()), counts, odd
    parted = np.insert(codes, begins[1:], ord(" ")).tobytes().decode("utf-32-le")
    return pc.split_pattern(pa.array([parted], pa.large_string()), " ").values, counts, odd


def _runs(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in turn, ids per word), from one call: a sentinel word stands between words."""
    line = " ".join(words)
    sentinel = next((c for c in _SENTINELS if c not in line), None)
    if sentinel is not None:
        mark, = tokenizer.encode(sentinel, add_special_tokens=False).ids
        found, = tokenizer.encode_batch_fast([f" {sentinel} ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        marks = ids == mark
        ends = np.append(np.flatnonzero(marks), len(ids))
        sizes = ends.copy()
        sizes[1:] -= ends[:-1] + 1
        return ids[~marks], sizes
    each = [found.ids for found in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    return np.fromiter((i for run in each for i in run), np.int64, int(sizes.sum())), sizes


class TextEncoder:
    """Encodes texts word by word with the ``tokenizers`` library.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words in turn; each distinct word of many texts is
    looked at once. Plain Latin letters, marks and digits are pieces that the
    tokenizer's splitting pattern parts and composition leaves as they are, so
    they skip both steps and each distinct piece is encoded once. Other words
    are encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # Takes pieces in lower case, their bytes as the vocabulary writes them.
        self._plain = Tokenizer.from_file(path)
        self._plain.normalizer = None
        self._plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._bytes = np.arange(256, dtype=np.uint32)
        for code in range(0x80, 0x100):
            char = chr(code)
            (text, _), = written.pre_tokenize_str(char)
            self._bytes[list(char.encode())] = list(map(ord, text))
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._known = WordTable(self._encode, limit=400_000, dtype=np.int32)
        self._odd = WordTable(lambda words: _runs(self._tokenizer, words), limit=100_000, dtype=np.int32)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_runs``, for pieces of plain characters: each ends with the one id that ends words."""
        line = self._bytes[np.frombuffer(" ".join(pieces).encode(), np.uint8)].tobytes().decode("utf-32-le")
        found, = self._plain.encode_batch_fast([line], add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        ends = np.flatnonzero(self._ends[ids])
        if len(ends) != len(pieces):
            return _runs(self._plain, line.split(" "))
        return ids, np.diff(ends, prepend=-1)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each word start, how many they are)."""
        pieces, n_pieces, odd = _pieces(words)
        pieces, which = _distinct(pieces)
        codes = self._known.codes(pieces.to_numpy(zero_copy_only=False).tolist())[which]
        ids, ends = self._known.runs(codes), np.concatenate([[0], np.cumsum(self._known.sizes(codes), dtype=np.int64)])
        last = np.cumsum(n_pieces)
        start, size = ends[last - n_pieces], ends[last] - ends[last - n_pieces]
        if odd.any():
            codes = self._odd.codes(words.filter(pa.array(odd)).to_pylist())
            size[odd] = self._odd.sizes(codes)
            start[odd] = len(ids) + np.cumsum(size[odd]) - size[odd]
            ids = np.concatenate([ids, self._odd.runs(codes)])
        return ids, start, size

    def __call__(self, text: str | None) -> np.ndarray:
        return next(self.many([text]))

    def many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; several texts are looked up together."""
        held: list[tuple[str, np.ndarray | None]] = []
        chars = 0
        for text in texts:
            if text and _SEPARATORS.search(text):
                held.append(("", np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int32)))
            else:
                held.append((text or "", None))
            chars += len(text or "")
            if chars >= CHARS_AT_ONCE or len(held) >= TEXTS_AT_ONCE:
                yield from self._settled(held)
                held, chars = [], 0
        yield from self._settled(held)

    def _settled(self, held: list[tuple[str, np.ndarray | None]]) -> Iterator[np.ndarray]:
        if not held:
            return
        # Arrow and Python agree on what white space is; at the ends of a text Arrow finds an empty word.
        parts = pc.utf8_split_whitespace(pa.array([text for text, _ in held], pa.large_string()))
        words, which = _distinct(parts.values)
        ids, start, size = self._words(words)
        start, size = start[which], size[which]
        end = np.cumsum(size)
        ids = ids[np.repeat(start - (end - size), size) + np.arange(int(size.sum()))]
        ends = np.concatenate([[0], end])[parts.offsets.to_numpy()].tolist()
        for (_, whole), first, last in zip(held, ends, ends[1:]):
            yield ids[first:last] if whole is None else whole


class EncoderHandle:
    """To be broadcast: a Python worker builds the encoder once and keeps its word cache from task to task."""

    def __init__(self, path: str):
        self._path = path

    def get(self) -> TextEncoder:
        if "_encoder" not in self.__dict__:
            self._encoder = TextEncoder(self._path)
        return self._encoder
