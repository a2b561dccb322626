"""64-bit hashes of words and of runs of words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import cache

CACHE_WORDS = 200_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xD6E8FEB86659FD93)
SHIFT = np.uint64(29)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()
cache("words", _words.clear)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """xxh3 of each word; a bounded cache serves the repeated ones."""
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, size: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """A hash for every run of `size` consecutive words, chained in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h ^= words[k : k + n]
        h *= multiplier
        h ^= h >> SHIFT
    return h


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of hashes."""
    h = (h ^ np.uint64(seed)) * SECOND
    h ^= h >> np.uint64(32)
    h *= MULTIPLIER
    return h ^ (h >> SHIFT)
