"""Hashes of words and word windows, made in Python workers with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

def _odd(seed: int, count: int = 64) -> np.ndarray:
    """Random odd numbers; regular ones would let windows of few different words collide."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, count, np.uint64) | np.uint64(1)


#: Multipliers of the word positions in a window, two independent sets.
FIRST, SECOND = _odd(1), _odd(2)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finalizer; one to one)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def window_hashes(hashes: np.ndarray, size: int, factors: np.ndarray = FIRST) -> np.ndarray:
    """Hash of every run of ``size`` words; empty if there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, np.uint64(size), np.uint64)
    for j in range(size):
        total += hashes[j : j + count] * factors[j]
    return mixed(total)
