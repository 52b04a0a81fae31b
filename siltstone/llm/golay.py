"""The binary [23, 12, 7] Golay code as a hash that forgives errors.

Every 23-bit word has one nearest codeword, at distance 3 or less; words at
distance 3 have five more codewords at distance 4.  ``near`` gives these one or
six codewords as 12-bit indices.  Two facts hold, which the tests prove for all
cosets: words that differ in two bits or fewer share an index; words that differ
in one bit share the nearest index of either with an index of the other.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 divides x^23 + 1 and generates the code.
GENERATOR = 0b101011100011
LENGTH, PARITY_BITS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, PARITY_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - PARITY_BITS)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of each 12-bit head; error patterns by syndrome, nearest first; how many there are."""
    heads = np.array([_remainder(head << PARITY_BITS) for head in range(1 << 12)], dtype=np.int32)
    errors = np.zeros((1 << PARITY_BITS, 6), dtype=np.int32)
    counts = np.zeros(1 << PARITY_BITS, dtype=np.int64)
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            syndrome = _remainder(error)
            errors[syndrome, counts[syndrome]] = error
            counts[syndrome] += 1
    return heads, errors, counts


def near(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word up to six 12-bit codeword indices, nearest first, and their number (1 or 6)."""
    heads, errors, counts = _tables()
    words = words.astype(np.int32)
    syndrome = (words & 0x7FF) ^ heads[words >> PARITY_BITS]
    return (words[:, None] ^ errors[syndrome]) >> PARITY_BITS, counts[syndrome]
