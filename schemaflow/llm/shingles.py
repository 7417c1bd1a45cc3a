"""Word shingles of whole texts as sorted arrays of distinct 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 5
FACTOR = 0x9E3779B97F4A7C15
POWERS = np.array([pow(FACTOR, SIZE - i, 2**64) for i in range(SIZE)], dtype=np.uint64)
MEMO_WORDS = 500_000


class WordHashes(dict):
    """A bounded memo from words to 64-bit hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


class Shingler:
    def __init__(self):
        self.words = WordHashes()

    def hashes(self, text: bytes) -> np.ndarray:
        """Of the distinct five-word shingles; of the whole sequence if it has fewer words; none without words.

        Words are lower-cased in A-Z and end at ASCII white space.
        """
        words = text.lower().split()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = len(h)
        if n >= SIZE:
            out = h[: n - SIZE + 1] * POWERS[0]
            for i in range(1, SIZE):
                out += h[i : n - SIZE + 1 + i] * POWERS[i]
            return np.unique(mixed(out))
        # The number of words enters, so that a short sequence never equals a shingle.
        return mixed((h * POWERS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n + 1)) if n else h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
