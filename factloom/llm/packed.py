"""Counts of hashed keys, nearly all of which are rare: keys move as bytes, some thousands a row, and are counted by sorting.

Of a key's hash the first COUNTED bits count, so a few keys are taken for others (one in a thousand of 10^9), which callers
allow for: what is found to repeat is a filter. Sorted, a key costs three bytes: its other 16 bits follow from where it stands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from factloom.llm.common import released

#: Bits of a key's hash that are counted: FINE bits by place, three bytes as they are.
COUNTED = 40
FINE = COUNTED - 24
SHIFT = np.uint64(24)


def head_of(key: np.ndarray) -> np.ndarray:
    """The first COUNTED bits of keys."""
    return key.view(np.uint64) >> np.uint64(64 - COUNTED)


def _cut(flat: bytes, at: np.ndarray, part: np.ndarray, size: int) -> pa.Array:
    """Of items of that size, that begin at at[i] for part i, those of each of the parts."""
    return pa.array([flat[x:y] for x, y in zip((at[part] * size).tolist(), (at[part + 1] * size).tolist(), strict=True)], pa.binary())


def packed_keys(head: np.ndarray, bits: int) -> pa.RecordBatch:
    """part (the first `bits` bits of a key's head, FINE at most), sizes (how many of the next are in each range of FINE bits), once
    (the last three bytes of those that occur once, in order), more (head and count of the others, eight bytes each)."""
    head = np.sort(head)
    first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]][: len(head)])
    n = np.diff(np.r_[first, len(head)])
    head = head[first]
    single = n == 1
    sizes = np.bincount((head[single] >> SHIFT).astype(np.int64), minlength=1 << FINE)
    if sizes.max() >= 1 << 16:  # more than a size can tell
        single &= sizes[(head >> SHIFT).astype(np.int64)] < 1 << 16
        sizes[sizes >= 1 << 16] = 0
    once, more = head[single], head[~single]
    low = np.ascontiguousarray(once.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3])
    counts = np.stack([more, n[~single].astype(np.uint64)], axis=1)
    a = np.r_[0, np.cumsum(sizes)][:: 1 << FINE - bits]
    b = np.searchsorted(more, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(COUNTED - bits))
    part = np.flatnonzero((a[1:] > a[:-1]) | (b[1:] > b[:-1]))
    each = np.arange((1 << bits) + 1)
    columns = [pa.array(part.astype(np.int32)), _cut(sizes.astype("<u2").tobytes(), each, part, 2 << FINE - bits), _cut(low.tobytes(), a, part, 3), _cut(counts.tobytes(), b, part, 16)]
    return pa.RecordBatch.from_arrays(columns, ["part", "sizes", "once", "more"])


def repeated_keys(table: pa.Table, bits: int) -> pa.RecordBatch:
    """key (the head) and n of the keys of packed parts, all of whose rows are there, that occur twice or more."""
    low = np.frombuffer(b"".join(table["once"].to_pylist()), np.uint8).reshape(-1, 3)
    once = np.zeros((len(low), 8), np.uint8)
    once[:, :3] = low
    once = once.view("<u8")[:, 0].astype(np.uint64)
    sizes = np.frombuffer(b"".join(table["sizes"].to_pylist()), "<u2")
    fine = (table["part"].to_numpy().astype(np.uint64) << np.uint64(FINE - bits))[:, None] + np.arange(1 << FINE - bits, dtype=np.uint64)
    once |= np.repeat(fine.ravel(), sizes) << SHIFT
    once.sort()
    more = np.frombuffer(b"".join(table["more"].to_pylist()), np.uint64).reshape(-1, 2)
    key, which = np.unique(more[:, 0], return_inverse=True)
    n = np.bincount(which, more[:, 1], len(key)).astype(np.int64)
    n += np.searchsorted(once, key, side="right") - np.searchsorted(once, key)
    key, n = key[n > 1], n[n > 1]
    first = np.flatnonzero(np.r_[True, once[1:] != once[:-1]][: len(once)])
    count = np.diff(np.r_[first, len(once)])
    first, count = first[count > 1], count[count > 1]
    other = np.isin(once[first], key, invert=True)
    return pa.RecordBatch.from_arrays([pa.array(np.r_[key, once[first[other]]].view(np.int64)), pa.array(np.r_[n, count[other]])], ["key", "n"])


def repeated_heads(rows: DataFrame, heads: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], most: int = 1_000_000) -> DataFrame:
    """key, n of the heads that occur twice or more; heads: those of a task's batches, some at a time."""
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(FINE, max(8, (16 * spread - 1).bit_length()))

    def pack(batches):
        held, n = [], 0
        for head in heads(batches):
            held.append(head)
            n += len(head)
            if n > most:
                yield packed_keys(np.concatenate(held), bits)
                held, n = [], 0
        if n:
            yield packed_keys(np.concatenate(held), bits)

    def count(batches):
        held, size = [], 0
        for batch in batches:
            part = batch["part"].to_numpy()
            start = 0
            for cut in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]:
                if held and part[start] != last and size > 4_000_000:
                    yield repeated_keys(pa.Table.from_batches(held), bits)
                    held, size = [], 0
                if cut > start:
                    held.append(batch.slice(start, cut - start))
                    size += sum(pc.sum(pc.binary_length(held[-1][c])).as_py() for c in ("sizes", "once", "more"))
                    last = part[start]
                start = cut
        if held:
            yield repeated_keys(pa.Table.from_batches(held), bits)
        del held
        released()

    packed = rows.mapInArrow(pack, "part int, sizes binary, once binary, more binary")
    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(count, "key long, n long")
