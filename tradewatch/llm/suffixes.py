"""Suffix order of integer sequences by prefix doubling, in numpy."""

from __future__ import annotations

import numpy as np


def doubled_ranks(first: np.ndarray, known: int = 1, depth: int | None = None, keep: bool = True):
    """Yield (length, ranks): the order of all suffixes by their first ``length`` symbols, the length doubling.

    ``first`` orders the suffixes by their first ``known`` symbols. The rank of a suffix is the number of suffixes
    that are smaller, so suffixes that agree so far share a rank. Those whose rank is their own are left alone from
    then on. It ends when no two agree, or when ``depth`` symbols are looked at. Without ``keep`` one array is changed in place.
    """
    n = len(first)
    if not n:
        return
    order = np.argsort(first)
    sorted_first = first[order]
    new = np.concatenate([[True], sorted_first[1:] != sorted_first[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    last = np.concatenate([new[1:], [True]])
    active = order[~(new & last)]
    yield known, rank
    while len(active) and (depth is None or known < depth):
        follower = active + known
        second = np.where(follower < n, rank[np.minimum(follower, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        by_key = np.argsort(key)
        active, key = active[by_key], key[by_key]
        old = rank[active]
        place = np.arange(len(active))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], old[1:] != old[:-1]])
        head = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy() if keep else rank
        rank[active] = old + head - np.maximum.accumulate(np.where(group, place, 0))
        last = np.concatenate([new[1:], [True]])
        active = active[~(new & last)]
        known *= 2
        yield known, rank


def suffix_array(first: np.ndarray, known: int = 1, depth: int | None = None) -> np.ndarray:
    """Suffix starts in order."""
    rank = np.zeros(0, np.int64)
    for _, found in doubled_ranks(first, known, depth, keep=False):
        rank = found
    return np.argsort(rank)


def common_prefixes(levels: list[tuple[int, np.ndarray]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of each pair of suffixes, from the ranks of all lengths (first known = 1)."""
    n = len(levels[0][1]) if levels else 0
    out = np.zeros(len(left), np.int64)
    for length, rank in reversed(levels):
        a, b = left + out, right + out
        inside = (a < n) & (b < n)
        same = np.zeros(len(left), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        out[same] += length
    return out


class WaveletMatrix:
    """Ranks of symbols in a sequence, many at a time: one bit vector with counts for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.n = bits, len(symbols)
        self.ones, self.zeros = [], []
        current = symbols.astype(np.int64)
        for bit in range(bits - 1, -1, -1):
            one = ((current >> bit) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(one, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(self.n - one.sum()))
            current = np.concatenate([current[~one], current[one]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the place ``end``."""
        start, stop = np.zeros(len(end), np.int64), end.astype(np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            is_one = ((symbol >> bit) & 1).astype(bool)
            a, b = ones[start], ones[stop]
            start = np.where(is_one, zeros + a, start - a)
            stop = np.where(is_one, zeros + b, stop - b)
        return stop - start
