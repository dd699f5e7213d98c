"""Word shingles of a text as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
# odd multipliers of a multilinear hash; independent, as related ones let texts of two words collide
_MULT = np.random.default_rng(20_240_601).integers(0, 2 ** 64, WIDTH + 1, np.uint64) | np.uint64(1)
CACHE_WORDS = 400_000  # bounds memory only: a full cache is emptied


class WordHashes(dict):
    """word bytes -> 64-bit hash, filled as words appear."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes. Bytes.lower() folds A-Z only, and
    bytes.split() splits on the space and the controls 9 to 13 only. With fewer
    than five words the whole sequence is one shingle; without words, none."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    if len(w) < WIDTH:
        s = np.array([len(w)], np.uint64) * _MULT[WIDTH]
        for i in range(len(w)):
            s = s + h[i:i + 1] * _MULT[i]
        return _mix(s)
    n = len(w) - WIDTH + 1
    s = h[:n] * _MULT[0]
    for i in range(1, WIDTH):
        s = s + h[i:i + n] * _MULT[i]
    return np.unique(_mix(s))
