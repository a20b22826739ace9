"""Vectorised hashing of words, word shingles and byte windows.

Strings are hashed as polynomials modulo 2**64 in an odd base, taken from prefix
sums, so every substring of a batch costs the same few array operations. The
results are finished with a bijective mixer. Hashes name candidates; results
that must be exact are confirmed on the strings or on wider digests.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
MASK64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
GOLDEN = U(0x9E3779B97F4A7C15)

_byte_values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = U(base & MASK64)
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n + 1]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes as they are."""
    return raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)


class Hashed:
    """Prefix sums of one byte buffer; ``span`` hashes any of its substrings."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.n = n
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_byte_values[raw] * _power_table(BASE, n)[:n], out=self.sums[1:])
        self.back = _power_table(BASE_INVERSE, n)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def every(self, width: int) -> np.ndarray:
        """Hash of the window of ``width`` bytes at each start."""
        m = max(0, self.n - width + 1)
        return mix((self.sums[width:width + m] - self.sums[:m]) * self.back[:m])


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that never cross a row border: starts, ends, words before each row."""
    n = len(mask)
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] = mask[inner]
    stops = mask.copy()
    stops[:-1] &= ~mask[1:]
    stops[inner - 1] = mask[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of k consecutive words at each start, borders of rows not regarded."""
    m = max(0, len(words) - k + 1)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        out *= U(BASE)
        out += words[j:j + m]
    return mix(out)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each window of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out
