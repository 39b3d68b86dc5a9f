r"""Sets of word shingles as sorted 64-bit hashes, for many texts at a time.

A-Z are lower-cased; words are ``[^\x20\x09-\x0D]+``; a text's set holds its distinct runs of ``k`` words, or its whole sequence
as one where it has fewer words, and nothing where it has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from driftwatch.llm.common import SPACES, joined, mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_VALUE = mix(np.arange(256, dtype=np.uint64), 7) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for i, x in enumerate((_BASE, _INVERSE)):
            all_ = np.full(n, x, np.uint64)
            all_[0] = 1
            _POWERS[i] = np.cumprod(all_)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in a row, and the number of words of each text."""
    low = _LOWER[data]
    space = _SPACE[low]
    n = len(low)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    first, last = np.ones(n + 1, bool), np.ones(n + 1, bool)
    first[1:n], last[1:n] = space[:-1], space[1:]  # first[i]: a word can start at i; last[i]: it can end before i
    first[offsets], last[offsets] = True, True
    starts = np.flatnonzero(first[:-1] & ~space)
    ends = np.flatnonzero(last[1:] & ~space) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[low] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64), 3)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    data, offsets = joined(column)
    words, counts = word_hashes(data, offsets)
    runs = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        runs = mix(runs ^ words[j : j + len(runs)], 11 + j)
    out, at = [], 0
    for n in counts.tolist():
        if n >= k:
            out.append(np.unique(runs[at : at + n - k + 1]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for j in range(n):
                whole = mix(whole ^ words[at + j], 101 + n)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
