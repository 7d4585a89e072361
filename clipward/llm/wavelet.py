"""A wavelet matrix over small codes: rank by levels, and bisection on ranks.

Each level holds one bit of every code, packed, with a count of set bits before each block of 512;
codes are reordered between levels by that bit, zeros first. A rank takes one step a level, so
counts of several codes up to a place combine from a few ranks, without looking at the sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

BLOCK = 512
_BYTES = BLOCK // 8


class _Bits:
    """A packed bit sequence with rank."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(bits)
        ones = np.bitwise_count(self.packed)
        whole = np.pad(ones, (0, -len(ones) % _BYTES)).reshape(-1, _BYTES)
        self.before = np.append(0, np.cumsum(whole.sum(axis=1, dtype=np.int64)))
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, i: int) -> int:
        """Set bits before place ``i``."""
        block = i // BLOCK
        part = self.packed[block * _BYTES : -(-i // 8)].tobytes()
        return int(self.before[block]) + (int.from_bytes(part) >> (-i % 8)).bit_count()


class WaveletMatrix:
    """Codes below ``2 ** n_levels``."""

    def __init__(self, codes: np.ndarray, n_levels: int):
        self.size = len(codes)
        self.levels: list[_Bits] = []
        for level in range(n_levels - 1, -1, -1):
            bit = (codes >> level & 1).astype(bool)
            self.levels.append(_Bits(bit))
            codes = np.concatenate([codes[~bit], codes[bit]])

    def rank(self, code: int, i: int) -> int:
        """How often ``code`` stands before place ``i``."""
        a, b = 0, i
        for depth, bits in enumerate(self.levels):
            a1, b1 = bits.ones(a), bits.ones(b)
            if code >> (len(self.levels) - 1 - depth) & 1:
                a, b = bits.zeros + a1, bits.zeros + b1
            else:
                a, b = a - a1, b - b1
            if a == b:
                return 0
        return b - a

    def count(self, codes: Sequence[int], i: int) -> int:
        """How often any of ``codes`` stands before place ``i``."""
        return sum(self.rank(code, i) for code in codes)

    def after(self, codes: Sequence[int], k: int) -> int:
        """The place just after the k-th occurrence of any of ``codes``, by bisection on ranks.

        0 for k = 0; the size where there are fewer.
        """
        lo, hi = 0, self.size
        while lo < hi:
            middle = (lo + hi) // 2
            if self.count(codes, middle) < k:
                lo = middle + 1
            else:
                hi = middle
        return lo
