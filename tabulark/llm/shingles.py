"""Words and word shingles of text blocks as 64-bit hashes (numpy, inside tasks).

A word is a maximal run of bytes that are not 0x20 or 0x09-0x0D, A-Z lower-cased.
Hashes are polynomial sums over random byte values with a bijective finaliser, so
two different shingles share one with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

from .blocks import PAD, U64, bounds, mix64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))[_LOWER]
_BASE = 0x5851F42D4C957F2D
_STEP = mix64(np.arange(1000, 1064, dtype=U64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _pow(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _powers[i] = np.cumprod(np.append(U64(1), np.full(n - 1, b, U64)))
    return _powers


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block and the index of each row's first word (n + 1 values)."""
    n = len(data) - PAD
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(off), np.int64)
    body = data[:n]
    word = ~_SPACE[body]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.append(False, word[:-1])
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.append(word[1:], False)
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    power, inverse = _pow(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[body] * power[:n], out=sums[1:])
    h = mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))
    return h, np.searchsorted(starts, off)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row, sorted within the row, and row boundaries (n + 1 values)."""
    words, first = word_hashes(data, off)
    count = np.diff(first)
    many = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    total = np.zeros(len(words), U64)
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(words)) - first[row]
    for j in range(min(size, len(words), len(_STEP))):
        inside = at + j < count[row]
        total[:len(words) - j] += np.where(inside[:len(words) - j], words[j:] * _STEP[j], U64(0))
    take = at < many[row]
    h, row = mix64(total[take] + U64(size)), row[take]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[:len(h)]
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(count) + 1))


def digests(h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit digest (two int64) of each row's set of hashes."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
        sums = np.append(U64(0), np.cumsum(mix64(h ^ U64(salt))))
        out.append(mix64(sums[cut[1:]] - sums[cut[:-1]] + np.diff(cut).astype(U64)).view(np.int64))
    return out[0], out[1]


__all__ = ["bounds", "digests", "shingle_sets", "word_hashes"]
