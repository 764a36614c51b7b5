"""Hashed character n-grams of words, for the linear and latent text models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_grams(words: Sequence[str], sizes: Sequence[int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams word by word, number of them per word).

    A word counts with a space on either side; n-grams never cross words.
    """
    text = " " + " ".join(words) + " "
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    spaces = np.cumsum(points == 32)
    owner = spaces - 1
    word, bucket = [], []
    for n in sizes:
        room = len(points) - n + 1
        if room <= 0:
            continue
        inside = spaces[n - 2:n - 2 + room] == spaces[:room] if n > 1 else points != 32
        at = np.flatnonzero(inside)
        value = np.full(len(at), n, np.uint64)
        for k in range(n):
            value = (value ^ points[at + k]) * _MIX
            value ^= value >> np.uint64(29)
        word.append(owner[at])
        bucket.append((value * _MIX >> np.uint64(64 - bits)).astype(np.int64))
    if not word:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    word, bucket = np.concatenate(word), np.concatenate(bucket)
    order = np.argsort(word, kind="stable")
    return bucket[order], np.bincount(word, minlength=len(words))[:len(words)]
