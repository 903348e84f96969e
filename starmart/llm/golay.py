"""The perfect binary Golay code (23, 12, 7): every 23-bit word is within 3 bits of exactly one codeword.

Two words that differ in at most one bit share a decoding index when the word of even weight gives its own decoding
and the word of odd weight gives all codewords within 4 bits (one or six): if ``c`` is the decoding of the even
word, the odd word is at most 4 bits from ``c``. Words of equal weight parity differ in an even number of bits, so
within one bit they are equal and give the same indices.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH = 23
CHECK_BITS = 11
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def syndromes(words: np.ndarray) -> np.ndarray:
    """The remainders of the words modulo the generator."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    return rest


@lru_cache
def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error pattern of at most 3 bits, and the five patterns of 4 bits (0 where there are none)."""
    near = [sum(1 << b for b in bits) for k in range(4) for bits in combinations(range(LENGTH), k)]
    leader = np.zeros(1 << CHECK_BITS, np.int64)
    leader[syndromes(np.array(near))] = near
    far = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), 4)])
    at = syndromes(far)
    others = np.zeros((1 << CHECK_BITS, 5), np.int64)
    order = np.argsort(at, kind="stable")
    values, starts = np.unique(at[order], return_index=True)
    for value, start in zip(values, starts):
        others[value] = far[order][start:start + 5]
    return leader, others


def parity(words: np.ndarray) -> np.ndarray:
    p = words.astype(np.int64)
    for shift in (16, 8, 4, 2, 1):
        p = p ^ (p >> shift)
    return p & 1


def indices(words: np.ndarray) -> np.ndarray:
    """Codeword indices of each word, six columns, -1 where unused: one for even weight, one or six for odd."""
    leader, others = error_patterns()
    s = syndromes(words)
    out = np.full((len(words), 6), -1, np.int64)
    out[:, 0] = (words ^ leader[s]) >> CHECK_BITS
    more = (words[:, None] ^ others[s]) >> CHECK_BITS
    out[:, 1:] = np.where((parity(words)[:, None] == 1) & (others[s] != 0), more, -1)
    return out
