"""A bidirectional FM-index over delimited words, searched for many patterns in step.

Text and reversed text share their suffix-rank intervals: a state is the
interval of a string among the sorted suffixes and that of its mirror image
among those of the mirrored text. Either end can be extended by a symbol.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols per sampled row of counts.
BLOCK = 16
END, STOP = 0, 1


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in sorted order, by doubling the compared length."""
    n = len(text)
    rank = text.astype(np.int64)
    width, order = 1, np.argsort(rank, kind="stable")
    while True:
        follow = np.zeros(n, np.int64)
        follow[:max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 2 + int(rank.max(initial=0))) + follow if width > 1 else rank * (int(rank.max(initial=0)) + 2) + follow
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2


class Counts:
    """How many symbols below c stand before place i of a sequence: sampled rows and a look into one block."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.symbols, blocks = symbols, len(sequence) // BLOCK + 1
        padded = np.full(blocks * BLOCK, symbols, np.int32)
        padded[:len(sequence)] = sequence
        self._blocks = padded.reshape(blocks, BLOCK)
        met = np.zeros((blocks + 1, symbols + 1), np.int32)
        flat = np.bincount((np.arange(blocks * BLOCK) // BLOCK) * (symbols + 1) + padded, minlength=blocks * (symbols + 1))
        np.cumsum(flat.reshape(blocks, symbols + 1), axis=0, out=met[1:])
        below = np.zeros((blocks + 1, symbols + 2), np.int32)
        np.cumsum(met, axis=1, out=below[:, 1:])
        self._below = below

    def symbols_at(self, place: np.ndarray) -> np.ndarray:
        return self._blocks.reshape(-1)[place]

    def __call__(self, place: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols below ``symbol``, equal to it) before each place."""
        block, rest = place // BLOCK, place % BLOCK
        row = self._blocks[block]
        inside = np.arange(BLOCK) < rest[:, None]
        less = self._below[block, symbol] + ((row < symbol[:, None]) & inside).sum(1)
        same = self._below[block, symbol + 1] - self._below[block, symbol] + ((row == symbol[:, None]) & inside).sum(1)
        return less, same


@dataclass
class States:
    """Search states in step: pattern, interval and its mirror (``size`` long), symbols left to match, errors made."""

    pattern: np.ndarray
    low: np.ndarray
    mirror: np.ndarray
    size: np.ndarray
    at: np.ndarray

    def chosen(self, which: np.ndarray) -> States:
        return States(*(getattr(self, f)[which] for f in ("pattern", "low", "mirror", "size", "at")))

    def __len__(self) -> int:
        return len(self.pattern)


def _joined(parts: list[States]) -> States:
    return States(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("pattern", "low", "mirror", "size", "at")))


class FmIndex:
    """Built from words as arrays of code points; symbols are dense numbers in code-point order."""

    def __init__(self, words: list[str]):
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(flat)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        # stop, word, stop, word, ..., stop, end
        text = np.full(len(flat) + len(words) + 2, STOP, np.int64)
        starts = np.cumsum(lengths + 1) - lengths
        within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        text[np.repeat(starts, lengths) + within] = np.searchsorted(self.alphabet, flat) + 2
        text[-1] = END
        self._starts = starts
        symbols = len(self.alphabet) + 2
        self.symbols, self.n = symbols, len(text)
        self._first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        order = suffix_order(text)
        self._order = order
        self._left = Counts(text[order - 1], symbols)
        back = np.concatenate([text[:-1][::-1], [END]])
        order = suffix_order(back)
        self._right = Counts(back[order - 1], symbols)

    def codes(self, words: list[str]) -> np.ndarray:
        """Symbols of all words in turn; -1 for a character that no indexed word has."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        if not len(self.alphabet):
            return np.full(len(points), -1, np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 2, -1).astype(np.int64)

    def start(self, patterns: int) -> States:
        zero = np.zeros(patterns, np.int64)
        return States(np.arange(patterns), zero.copy(), zero.copy(), np.full(patterns, self.n, np.int64), zero.copy())

    def extend(self, states: States, symbol: np.ndarray, leftwards: bool) -> States:
        """The states after one more symbol at an end; those that no text has go."""
        counts = self._left if leftwards else self._right
        near, far = (states.low, states.mirror) if leftwards else (states.mirror, states.low)
        known = symbol >= 0
        symbol = np.maximum(symbol, 0)
        less_low, low = counts(near, symbol)
        less_high, high = counts(near + states.size, symbol)
        near, far, size = self._first[symbol] + low, far + less_high - less_low, high - low
        low, mirror = (near, far) if leftwards else (far, near)
        return States(states.pattern, low, mirror, size, states.at).chosen(known & (size > 0))

    def branch(self, states: States, leftwards: bool) -> tuple[States, np.ndarray]:
        """Each state extended by every symbol but a stop that follows there, and the symbols."""
        counts, near = (self._left, states.low) if leftwards else (self._right, states.mirror)
        # A narrow interval names its symbols; a wide one is asked for each of the alphabet.
        k = len(self.alphabet)
        few = np.flatnonzero(states.size <= k)
        size = states.size[few]
        owner = np.repeat(few, size)
        place = np.repeat(near[few] - (np.cumsum(size) - size), size) + np.arange(len(owner))
        wide = np.flatnonzero(states.size > k)
        pairs = np.concatenate([owner * self.symbols + counts.symbols_at(place),
                                np.repeat(wide, k) * self.symbols + np.tile(np.arange(2, k + 2), len(wide))])
        pairs = np.unique(pairs)
        pairs = pairs[pairs % self.symbols > STOP]
        owner, symbol = pairs // self.symbols, pairs % self.symbols
        found = self.extend(States(np.arange(len(pairs)), states.low[owner], states.mirror[owner], states.size[owner], states.at[owner]),
                            symbol, leftwards)
        return States(states.pattern[owner[found.pattern]], found.low, found.mirror, found.size, found.at), symbol[found.pattern]

    def words_at(self, states: States) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, number of the word) of states whose string is a whole word between stops."""
        which = np.repeat(np.arange(len(states)), states.size)
        place = self._order[np.repeat(states.low, states.size) + np.arange(len(which)) - np.repeat(np.cumsum(states.size) - states.size, states.size)]
        return states.pattern[which], np.searchsorted(self._starts, place + 1)

    def near(self, patterns: list[str], exact_first: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word) of indexed words that are a pattern with one symbol replaced or inserted.

        With ``exact_first`` the first half is matched exactly, from the middle
        to the stop before it, and then extended over the second half with the
        error; otherwise the halves change places and directions.
        """
        flat = self.codes(patterns)
        length = np.fromiter(map(len, patterns), np.int64, len(patterns))
        middle, half = np.cumsum(length) - length + length // 2, length // 2
        halves = [(flat, middle, half, -1), (flat, middle, length - half, 1)]
        exact, other = halves if exact_first else halves[::-1]
        # Patterns with the same exact half share its search.
        number: dict[str, int] = {}
        names = (p[:len(p) // 2] if exact_first else p[len(p) // 2:] for p in patterns)
        own = np.fromiter((number.setdefault(name, len(number)) for name in names), np.int64, len(patterns))
        _, one = np.unique(own, return_index=True)
        found = self._exactly(self.start(len(one)), self._read(exact[0], exact[1][one], exact[2][one], exact[3]), leftwards=exact_first)
        at = np.full(len(number), -1, np.int64)
        at[found.pattern] = np.arange(len(found))
        met = np.flatnonzero(at[own] >= 0)
        states = found.chosen(at[own[met]])
        states.pattern = met
        return self.words_at(self._with_one_error(states, self._read(*other), leftwards=not exact_first))

    @staticmethod
    def _read(flat: np.ndarray, middle: np.ndarray, size: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the halves in the order in which they are read from the middle, with a stop after each: (all in turn, starts, sizes)."""
        start = np.cumsum(size + 1) - (size + 1)
        out = np.full(int((size + 1).sum()), STOP, np.int64)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(start, size) + step] = flat[np.repeat(middle, size) + (step if way > 0 else -1 - step)]
        return out, start, size + 1

    def _exactly(self, states: States, parts: tuple[np.ndarray, np.ndarray, np.ndarray], leftwards: bool) -> States:
        flat, start, size = parts
        done: list[States] = []
        step = 0
        while len(states):
            ended = size[states.pattern] == step
            done.append(states.chosen(ended))
            states = states.chosen(~ended)
            if not len(states):
                break
            states = self.extend(states, flat[start[states.pattern] + step], leftwards)
            step += 1
        out = _joined(done) if done else states
        out.at[:] = 0
        return out

    def _with_one_error(self, clean: States, parts: tuple[np.ndarray, np.ndarray, np.ndarray], leftwards: bool) -> States:
        """States that have read a part and its stop with exactly one symbol replaced or inserted."""
        flat, start, size = parts
        done: list[States] = []
        wrong = clean.chosen(np.zeros(len(clean), bool))
        while len(clean) or len(wrong):
            ended = size[wrong.pattern] == wrong.at
            done.append(wrong.chosen(ended))
            wrong = wrong.chosen(~ended)
            fresh = []
            if len(wrong):
                moved = self.extend(wrong, flat[start[wrong.pattern] + wrong.at], leftwards)
                moved.at = moved.at + 1
                fresh.append(moved)
            clean = clean.chosen(clean.at < size[clean.pattern])
            if len(clean):
                due = flat[start[clean.pattern] + clean.at]
                branched, symbol = self.branch(clean, leftwards)
                want = flat[start[branched.pattern] + branched.at]
                # Inserted: the symbol stands before the one that is due. Replaced: in its place, and not at the stop.
                fresh.append(branched.chosen(symbol != want))
                replaced = branched.chosen((symbol != want) & (want != STOP))
                replaced.at = replaced.at + 1
                fresh.append(replaced)
                clean = self.extend(clean, due, leftwards)
                clean.at = clean.at + 1
            wrong = _joined(fresh) if fresh else wrong.chosen(np.zeros(len(wrong), bool))
        return _joined(done) if done else wrong
