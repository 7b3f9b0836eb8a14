"""Hashes of words, lines, windows and word shingles for many texts at a time, with numpy over the UTF-8 bytes.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. Two polynomial hashes over the field of 2**31 - 1,
each with a base of its own, make one of 62 bits, which is mixed afterwards; equal strings have equal hashes
everywhere, and strings built to collide modulo 2**64 don't collide here. Polynomials modulo 2**64 serve only as keys
that may bring strings together, never to tell that they are equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE = _rng.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
PLACE = _rng.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
BASE = int(_rng.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
PRIME = 2**31 - 1
FIELD = np.uint64(PRIME)
BASES = tuple(int(x) for x in _rng.integers(2**20, PRIME, 2))
FIELD_BYTES = tuple(_rng.integers(1, PRIME, 256).astype(np.uint64) for _ in BASES)
_powers: dict[str, np.ndarray] = {}
#: Tables of powers that are kept between calls have so many entries at most.
KEPT_POWERS = 1 << 20
#: Bytes whose words are hashed at once, unless a single word is longer.
STRETCH = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, n.bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    up, down = _powers["up"][:n], _powers["down"][:n]
    if n > KEPT_POWERS:
        _powers.clear()
    return up, down


def fold(x: np.ndarray) -> np.ndarray:
    """A smaller number (under 2**32 if x is under 2**62) of the same remainder by PRIME."""
    return (x & FIELD) + (x >> np.uint64(31))


def remainder(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x under 2**63."""
    x = fold(fold(x))
    x[x >= FIELD] -= FIELD
    return x


def field_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of BASES, the first n powers of it and of its inverse in the field."""
    if "field" not in _powers or len(_powers["field"][0][0]) < n:
        size = 1 << max(16, n.bit_length())
        tables = []
        for base in BASES:
            pair = []
            for b in (base, pow(base, -1, PRIME)):
                table = np.ones(size, np.uint64)
                have = 1
                while have < size:
                    table[have : 2 * have] = remainder(table[:have] * np.uint64(pow(b, have, PRIME)))
                    have *= 2
                pair.append(table)
            tables.append(tuple(pair))
        _powers["field"] = tables
    out = [(up[:n], down[:n]) for up, down in _powers["field"]]
    if n > KEPT_POWERS:
        _powers.clear()
    return out


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each starts (one entry more than texts); nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def words(texts: pa.Array, lower: bool = True, between: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and at which of them each text starts (one entry more than texts).

    between: which bytes are no part of a word.
    """
    data, starts = raw(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    blank = between[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = blank[:-1]
    before[starts[:-1][starts[:-1] < n]] = True
    first = np.flatnonzero(before & ~blank)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    hashes = np.empty(len(first), np.uint64)
    stop = np.r_[first[1:], n]
    at = 0
    while at < len(first):  # words are taken by stretches of the text, so the tables stay small
        to = max(at + 1, int(np.searchsorted(stop, first[at] + STRETCH, side="right")))
        begin, end = int(first[at]), int(stop[to - 1])
        part = data[begin:end]
        where, until = first[at:to] - begin, stop[at:to] - begin - 1
        halves = []
        for (up, down), table in zip(field_powers(end - begin), FIELD_BYTES, strict=True):
            value = np.where(between, 0, table[LOWER] if lower else table).astype(np.uint64)[part]
            value *= up
            sums = np.cumsum(fold(value))  # of numbers under 2**32: exact
            halves.append(remainder(remainder(sums[until] - sums[where] + fold(value[where])) * down[where]))
        hashes[at:to] = mix(halves[0] << np.uint64(31) | halves[1])
        at = to
    return hashes, np.searchsorted(first, starts)


def shingle_sets(texts: pa.Array, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each text, sorted, as signed integers, and where each text's start.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    w, starts = words(texts, lower)
    sets, ends = [], [0]
    if len(w) >= k:
        rolled = w[: len(w) - k + 1] * PLACE[0]
        for j in range(1, k):
            rolled += w[j : len(w) - k + 1 + j] * PLACE[j]
        rolled = mix(rolled)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= k:
            got = np.sort(rolled[a : b - k + 1].view(np.int64))
            got = got[np.r_[True, got[1:] != got[:-1]]]
        elif b > a:
            got = mix(np.array([(w[a:b] * PLACE[: b - a]).sum() + np.uint64(b - a)], np.uint64)).view(np.int64)
        else:
            got = np.zeros(0, np.int64)
        sets.append(got)
        ends.append(ends[-1] + len(got))
    return np.concatenate(sets) if sets else np.zeros(0, np.int64), np.array(ends, np.int64)
