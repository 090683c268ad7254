"""Words of packed texts as arrays: spans, 64-bit hashes, shapes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes hashed in one go; a longer word is a step of its own.
_STEP = 1 << 18
_BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All bytes but ASCII letters, digits and those of other letters.
SIGNS = np.ones(256, bool)
SIGNS[48:58] = SIGNS[65:91] = SIGNS[97:123] = SIGNS[128:] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER = _BYTE_CODES.copy()
_LOWER[65:91] = _BYTE_CODES[97:123]


@lru_cache(4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def spans(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more than texts).

    A word is a run of bytes other than ``gaps`` (blank, tab and line ends); it never crosses texts.
    """
    inside = ~gaps[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    full = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[full] = inside[full]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    finish[last] = inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def span_hashes(codes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from prefix sums of a polynomial (Karp-Rabin) hash.

    ``starts`` must ascend. Memory is bound by the step and the longest span.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(starts, starts[i] + _STEP)), i + 1)
        low, high = int(starts[i]), int(ends[i:j].max())
        power, inverse = _powers(max(high - low, 1).bit_length())
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(codes[data[low:high]] * power[: high - low], out=sums[1:])
        first = starts[i:j] - low
        out[i:j] = (sums[ends[i:j] - low] - sums[first]) * inverse[first]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z as a-z, and the index of each text's first word."""
    starts, ends, first = spans(data, offsets, gaps)
    return span_hashes(_LOWER, data, starts, ends), first


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the index of each text's first run."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    runs = np.concatenate([[0], np.cumsum(counts)])
    total = len(hashes)
    if total < n:
        return np.zeros(0, np.uint64), runs
    h = np.full(total - n + 1, n, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(_BASE) + hashes[k : total - n + 1 + k])
    keep = np.ones(len(h), bool)
    for k in range(1, n):
        # runs that start fewer than n words before a text's end are none of its own
        late = first[1:] - k
        late = late[(late >= first[:-1]) & (late < len(h)) & (late >= 0)]
        keep[late] = False
    return h[keep], runs


#: Bytes by class: letters, capitals, digits; other signs stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[128:] = 97


def shape_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's shape: classes of its bytes with repeats as one (``Word!!`` as ``Aa!``)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    kinds = _CLASS[data]
    keep = np.ones(len(data), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return span_hashes(_BYTE_CODES, kinds[keep], at[starts], at[ends])
