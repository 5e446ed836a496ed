"""The perfect binary Golay code of length 23, over numpy arrays of 23-bit words."""

from __future__ import annotations

from itertools import combinations

import numpy as np

from pairloom.runtime import ship_by_value

# Code length, message bits, and the generator polynomial's coefficients.
LENGTH, MESSAGE, GENERATOR = 23, 12, 0b101011100011
CHECK = LENGTH - MESSAGE


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each word by the generator: zero for a codeword."""
    left = words.astype(np.uint32)
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        left = left ^ (((left >> bit) & 1) * np.uint32(GENERATOR << (bit - CHECK)))
    return left


def error_patterns() -> np.ndarray:
    """For each syndrome the one pattern of at most 3 bits, then those of 4 bits (0 if none).

    The code is perfect, so each syndrome has one pattern of 0 to 3 bits. Only those with 3
    bits have patterns of 4 besides, and then five of them.
    """
    table = np.zeros((1 << CHECK, 6), np.uint32)
    used = np.zeros(1 << CHECK, np.int64)
    for weight in range(5):
        at = np.array(list(combinations(range(LENGTH), weight)), np.int64)
        patterns = (1 << at).sum(axis=1).astype(np.uint32) if weight else np.zeros(1, np.uint32)
        for pattern, s in zip(patterns, syndromes(patterns)):
            table[s, used[s]] = pattern
            used[s] += 1
    return table


def near_codewords(words: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Message indices of all codewords within 4 bits, the nearest first; -1 where there are fewer.

    If y differs from x in one bit at most, then x's nearest codeword is within 4 bits of y.
    """
    words = words.astype(np.uint32)
    found = patterns[syndromes(words)]
    index = ((words[:, None] ^ found) >> CHECK).astype(np.int64)
    index[:, 1:][found[:, 1:] == 0] = -1
    return index


ship_by_value(__name__)
