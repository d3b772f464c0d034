"""Hashed words and word windows of texts, for the operators that compare them."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers; other seeds give other orders."""
    with np.errstate(over="ignore"):
        h = h + np.uint64(seed * 2 + 1) * FACTOR
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    factor = mixed(np.array([seed], np.uint64), 7)[0] | np.uint64(1)
    total = hashes[:count].copy()
    with np.errstate(over="ignore"):
        for k in range(1, size):
            total = total * factor + hashes[k:k + count]
    return mixed(total, seed)
