"""Vectorised 64-bit hashes of byte ranges and word windows.

A range's hash is a polynomial in odd multipliers modulo 2**64, taken from prefix sums and then
mixed, so all ranges of an array cost a few passes. Equal content has equal hashes wherever it
starts.
"""

from __future__ import annotations

import functools

import numpy as np

_BYTE = 0x9E3779B97F4A7C15
_WORD = 0xC2B2AE3D27D4EB4F
SLICE = 1 << 19

#: White space of the word pattern: space and U+0009 to U+000D.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = np.array(x, np.uint64)
    mix_in_place(x, np.empty_like(x))
    return x


def mix_in_place(x: np.ndarray, spare: np.ndarray) -> None:
    """``mix`` of an array, written over it; ``spare`` is as long and loses what it holds."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        np.right_shift(x, np.uint64(33), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint64(factor), out=x)
    np.right_shift(x, np.uint64(33), out=spare)
    np.bitwise_xor(x, spare, out=x)


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below ``n`` at least."""
    return _powers(base, 1 << max(16, (n - 1).bit_length()))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    _, down = powers(base, len(sums))
    return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(data, _BYTE)


def byte_hashes(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return range_hashes(sums, lo, hi, _BYTE)


def _slices(data: np.ndarray, space: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive ranges of about SLICE bytes that end at white space."""
    cuts, at = [], 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and not space[data[end]]:
            more = np.flatnonzero(space[data[end : end + SLICE]])
            end = end + int(more[0]) if len(more) else end + SLICE
        end = min(end, len(data))
        cuts.append((at, end))
        at = end
    return cuts


def words(data: np.ndarray, space: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word in a byte array; ``space`` marks the separators."""
    found = []
    for at, end in _slices(data, space):
        part = data[at:end]
        letter = np.zeros(len(part) + 2, np.int8)
        letter[1:-1] = ~space[part]
        edges = np.diff(letter)
        lo, hi = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        found.append((lo + at, hi + at, byte_hashes(byte_sums(part), lo, hi)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def window_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = prefix_sums(word_hashes, _WORD)
    lo = np.arange(n)
    return range_hashes(sums, lo, lo + size, _WORD)


def joined(texts: list[bytes], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array with a gap after each, and where each starts."""
    data = np.frombuffer(b"".join(part for t in texts for part in (t, gap)), np.uint8)
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    return data, np.cumsum(sizes) - sizes


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``width`` from one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0
