"""A word cache for one task: every distinct word is worked out once, texts are then array look-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np


class _Index(dict):
    """Numbers words in order of first sight and remembers the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, word):
        code = self[word] = len(self)
        self.new.append(word)
        return code


class WordTable:
    """Maps a word to a run of integers that ``expand`` gives for it.

    ``limit`` bounds the memory: beyond it the cache starts anew, which never
    changes a result. ``dtype`` is that of the integers kept.
    """

    def __init__(self, expand: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 400_000, dtype: type = np.int64):
        self._expand, self._limit, self._dtype = expand, limit, dtype
        self._reset()

    def _reset(self):
        self._index = _Index()
        self._flat = np.zeros(1 << 16, self._dtype)
        self._used = 0
        self._start = np.zeros(1 << 14, np.int64)
        self._size = np.zeros(1 << 14, np.int32)

    def _append(self, words: list, first: int):
        values, sizes = self._expand(words)
        need, last = self._used + len(values), first + len(words)
        if need > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros(max(need, len(self._flat)), self._dtype)])
        if last > len(self._size):
            room = max(last, len(self._size))
            self._start = np.concatenate([self._start, np.zeros(room, np.int64)])
            self._size = np.concatenate([self._size, np.zeros(room, np.int32)])
        self._flat[self._used:need] = values
        self._size[first:last] = sizes
        self._start[first:last] = self._used + np.cumsum(sizes) - sizes
        self._used = need

    def codes(self, words: list) -> np.ndarray:
        """Numbers of the words, valid until the next call."""
        if len(self._index) > self._limit:
            self._reset()
        index = self._index
        first = len(index)
        found = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        if index.new:
            self._append(index.new, first)
            index.new = []
        return found

    def sizes(self, codes: np.ndarray) -> np.ndarray:
        return self._size[codes]

    def runs(self, codes: np.ndarray) -> np.ndarray:
        """The runs of the words with these numbers, one after the other."""
        size = self._size[codes]
        total = int(size.sum())
        if not total:
            return np.zeros(0, self._dtype)
        shift = self._start[codes] - (np.cumsum(size) - size)
        return self._flat[np.repeat(shift, size) + np.arange(total)]

    def expand(self, words: Iterable) -> np.ndarray:
        return self.runs(self.codes(list(words)))
