"""Fuzzy keys from the binary Golay code of length 23."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, which generates the code.
GENERATOR = 0b101011100011
LENGTH, CHECK = 23, 11


def _remainder(v: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - CHECK)
    return v


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The syndrome of each bit, and the error pattern (three bits at most) of each syndrome."""
    bits = np.array([_remainder(1 << b) for b in range(LENGTH)])
    errors = np.zeros(1 << CHECK, dtype=np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(LENGTH), weight):
            errors[np.bitwise_xor.reduce(bits[list(places)])] = sum(1 << p for p in places)
    return bits, errors


def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """The index (12 data bits) of the codeword nearest to each 23-bit word; the code is perfect, so it is unique."""
    bits, errors = _tables()
    syndrome = np.zeros_like(words)
    for b in range(LENGTH):
        syndrome ^= np.where(words >> b & 1, bits[b], 0)
    return (words ^ errors[syndrome]) >> CHECK


def fuzzy_keys(words: np.ndarray) -> np.ndarray:
    """Codeword indices near each word: row k holds those of word k and of its one-bit flips, sorted, repeats as -1.

    Two words that differ in two bits or fewer have a word within one flip of both, so
    they share the index that word decodes to. A word has one index or six.
    """
    flips = np.r_[0, 1 << np.arange(LENGTH)]
    near = np.sort(nearest_codeword(words.astype(np.int64)[:, None] ^ flips), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return near
