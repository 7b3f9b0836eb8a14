"""Sorting suffixes by hashes: mergesort whose comparisons are logarithmic.

Prefix polynomial hashes give the hash of any substring in constant time, so the common extension of two
suffixes is found by binary search over its length, and the next byte decides. All groups are merged in step:
in each round every element finds its rank in the neighbouring run by binary search. Runs of suffixes that are
equal over the whole depth are compared byte by byte in the end, so a collision of hashes can't join strings.
"""

from __future__ import annotations

import numpy as np

from factloom.llm.textkernel import BYTE, FIELD_BYTES, field_powers, fold, mix, powers, remainder


class FieldHashes:
    """Hashes of 62 bits of substrings of one array of bytes, by two prefix polynomials over a prime field."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.down, self.sums = [], []
        for (up, down), table in zip(field_powers(len(data) + 1), FIELD_BYTES, strict=True):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(fold(table[data] * up[:-1]), out=sums[1:])  # of numbers under 2**32: exact
            self.down.append(down)
            self.sums.append(sums)

    def hash(self, at: np.ndarray, length) -> np.ndarray:
        high, low = (remainder(remainder(sums[at + length] - sums[at]) * down[at]) for sums, down in zip(self.sums, self.down, strict=True))
        return mix(high << np.uint64(31) | low)


class Substrings:
    """Keys of substrings of one array of bytes: equal for equal strings, nothing more (modulo 2**64)."""

    def __init__(self, data: np.ndarray, table: np.ndarray = BYTE):
        up, self.down = powers(len(data) + 1)
        self.data = data
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:-1], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        """The hashes of all substrings of one length."""
        out = self.sums[length:] - self.sums[:-length]
        out *= self.down[: len(out)]
        return out

    def hash(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.down[at]


def before_or_equal(text: Substrings, a: np.ndarray, b: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether suffix a is less than suffix b, and whether they are equal, over `depth` bytes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), depth, np.int64)
    equal = text.hash(a, depth) == text.hash(b, depth)
    low[equal] = depth
    open_ = np.flatnonzero(~equal)
    high[open_] = depth - 1
    for _ in range(depth.bit_length()):
        if not len(open_):
            break
        mid = (low[open_] + high[open_] + 1) // 2
        same = text.hash(a[open_], mid) == text.hash(b[open_], mid)
        low[open_] = np.where(same, mid, low[open_])
        high[open_] = np.where(same, high[open_], mid - 1)
        open_ = open_[low[open_] < high[open_]]
    at = np.minimum(low, depth - 1)
    return ~equal & (text.data[a + at] < text.data[b + at]), equal


def sort_groups(text: Substrings, suffix: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """An order of the suffixes (group is sorted already) in which each group's are sorted over `depth` bytes."""
    n = len(suffix)
    order = np.arange(n)
    if not n:
        return order
    first = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
    size = np.diff(np.r_[first, n])
    base, count = np.repeat(first, size), np.repeat(size, size)
    run = 1
    while run < size.max():
        here = np.flatnonzero(count > run)
        inside = here - base[here]
        mine = inside // run
        other = mine ^ 1
        start = other * run
        stop = np.minimum(start + run, count[here])
        start = np.minimum(start, stop)
        low, high = start.copy(), stop.copy()
        left = mine % 2 == 0
        value = suffix[order[here]]
        for _ in range(run.bit_length() + 1):
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            less, equal = before_or_equal(text, suffix[order[base[here[open_]] + mid]], value[open_], depth)
            # Elements of the left run come before equal ones of the right run.
            goes = less | (equal & ~left[open_])
            low[open_] = np.where(goes, mid + 1, low[open_])
            high[open_] = np.where(goes, high[open_], mid)
        place = base[here] + np.minimum(mine, other) * run + (inside - mine * run) + (low - start)
        merged = order.copy()
        merged[place] = order[here]
        order = merged
        run *= 2
    return order


def equal_runs(text: Substrings, suffix: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """For sorted suffixes, the number of the run of equal strings that each is in, verified byte by byte."""
    n = len(suffix)
    same = np.zeros(n, bool)
    if n > 1:
        same[1:] = (group[1:] == group[:-1]) & (text.hash(suffix[1:], depth) == text.hash(suffix[:-1], depth))
        at = np.flatnonzero(same)
        for i in range(0, len(at), 100_000):
            part = at[i : i + 100_000]
            span = np.arange(depth)
            same[part] = (text.data[suffix[part][:, None] + span] == text.data[suffix[part - 1][:, None] + span]).all(axis=1)
    return np.cumsum(~same) - 1
