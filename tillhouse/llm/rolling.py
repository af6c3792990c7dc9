"""Hashes of byte ranges and words for many texts at once.

A text's bytes are mapped to random 64-bit values and summed with powers of an odd base; the
hash of any range is a difference of two sums, brought to the range's own origin.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
LOWER = BYTE_VALUES.copy()
LOWER[65:91] = BYTE_VALUES[97:123]
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True

_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        both = [np.full(size, b, np.uint64) for b in (BASE, INVERSE)]
        for powers in both:
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
        _POWERS, _INVERSES = both
    return _POWERS, _INVERSES


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Ranges:
    """Hashes of ranges of some bytes."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        powers, self.inverses = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        terms = values[data]
        terms *= powers[: len(data)]
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hashes of [start, end); the length counts too."""
        raw = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def sliding(self, width: int) -> np.ndarray:
        """Mixed hashes of all ranges of one width."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.inverses[:n])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not blank."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~IS_BLANK[data]
    edges = np.diff(solid)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def shingles(data: bytes, size: int) -> np.ndarray:
    """Distinct hashes of runs of `size` words, A-Z as a-z, sorted; of all words
    together when there are fewer; none without words."""
    own = np.frombuffer(data, np.uint8)
    starts, ends = word_bounds(own)
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = Ranges(own, LOWER).of(starts, ends)
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = mix(total + words[i : i + n])
    return np.unique(total)
