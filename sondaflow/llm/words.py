"""Words of many texts at once, as 64-bit hashes, by array operations on their bytes.

A word is a longest run of bytes other than space and 0x09-0x0D; A-Z count as
a-z. Those bytes never occur inside a multi-byte UTF-8 character, so this equals
the pattern ``[^\\x20\\x09-\\x0D]+`` on code points.
"""

from __future__ import annotations

import numpy as np

# Odd constants of the hash functions; any would do.
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, … modulo 2**64."""
    table = np.full(max(1, count), base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    z = values ^ (values >> np.uint64(30))
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1] if len(data) else inside
    after = np.concatenate((inside[1:], [False])) & ~edge[1:] if len(data) else inside
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word and for each text the number of words before it."""
    starts, ends, firsts = word_bounds(data, offsets)
    return hashes_between(lowered(data), starts, ends), firsts


def hashes_between(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[:len(data)], out=sums[1:])
    back = powers(pow(BASE, -1, 1 << 64), len(data))
    raw = (sums[ends] - sums[starts]) * back[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(STEP))


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and for each text the number of runs before it.

    A text with fewer words, but not none, has its whole sequence as one run.
    """
    counts = np.diff(firsts)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    before = np.concatenate(([0], np.cumsum(runs)))
    owner = np.repeat(np.arange(len(counts)), runs)
    at = firsts[owner] + np.arange(len(owner)) - before[owner]
    length = np.minimum(counts[owner], size)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    total = length.astype(np.uint64) * np.uint64(STEP)
    for k in range(size):
        total = total * np.uint64(BASE) + np.where(k < length, padded[at + k], np.uint64(0))
    return mix(total), before
