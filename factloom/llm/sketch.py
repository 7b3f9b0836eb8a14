"""A bounded table that tells, for 64-bit keys, a class of how often each occurs in the corpus.

The exact counts of keys that occur twice or more are classed by powers of two and written into an array of
bytes (of bits if only membership is kept), two cells a key; a look-up takes the lesser cell. It never says too
little. The array's size follows the number of keys up to `MOST_BITS`, so what is sent to the driver and broadcast is
bounded at every size of the input (64 MB). More keys than `fits` says would make it say too much ever more often; callers then
join by key instead, to the same result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import released, tidy
from factloom.llm.textkernel import mix

BLOCK_BITS = 16
SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(keys.view(np.uint64) ^ s) >> np.uint64(64 - bits)).astype(np.int64) for s in SEEDS]


@dataclass
class Table:
    cells: np.ndarray  # a byte for each cell, or its bits if only membership is kept
    bits: int
    members: bool


#: Cells are 2 to this at most: bytes for classes of counts, bits for members.
MOST_BITS = {False: 26, True: 29}


def fits(n_keys: int, members: bool = False) -> bool:
    """Whether a table of that many keys still turns nearly all others away (9 in 10 or more)."""
    return 6 * n_keys <= 1 << MOST_BITS[members]


def look_up(table: Table, keys: np.ndarray) -> np.ndarray:
    """0 for keys that are not in the table, else 1 + floor(log2(count)) or more (1 if only membership is kept)."""
    a, b = _cells(keys, table.bits)
    if table.members:
        return (table.cells[a >> 3] >> (a & 7).astype(np.uint8)) & (table.cells[b >> 3] >> (b & 7).astype(np.uint8)) & np.uint8(1)
    return np.minimum(table.cells[a], table.cells[b])


def build(counts: DataFrame, n_keys: int, members: bool = False) -> Table:
    """The table of counts(key long, n long), which has n_keys rows; members: only that a key is there."""
    bits = min(MOST_BITS[members], max(BLOCK_BITS, (12 * n_keys).bit_length()))

    def sparse(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            keys = batch["key"].to_numpy().astype(np.int64)
            kind = (1 + np.log2(np.maximum(1, batch["n"].to_numpy()))).astype(np.uint8)
            for cell in _cells(keys, bits):
                order = np.argsort(cell)
                c, v = cell[order], kind[order]
                entry = np.empty(len(c), [("low", "<u2"), ("kind", "u1")])
                entry["low"], entry["kind"] = c & ((1 << BLOCK_BITS) - 1), v
                cuts = [0, *(np.flatnonzero(np.diff(c >> BLOCK_BITS)) + 1).tolist(), len(c)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if b > a:
                        held.setdefault(int(c[a]) >> BLOCK_BITS, []).append(entry[a:b].tobytes())
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([b"".join(x) for x in held.values()], pa.binary())], ["block", "entries"])
        held.clear()
        released()

    def dense(table: pa.Table) -> pa.Table:
        out = np.zeros(1 << BLOCK_BITS, np.uint8)
        for x in table["entries"]:
            entry = np.frombuffer(x.as_py(), [("low", "<u2"), ("kind", "u1")])
            np.maximum.at(out, entry["low"], entry["kind"])
        if members:
            out = np.packbits(out > 0, bitorder="little")
        return pa.table({"block": table["block"][:1], "cells": pa.array([zlib.compress(out.tobytes(), 1)], pa.binary())})

    size = 1 << BLOCK_BITS >> (3 if members else 0)
    cells = np.zeros(size << (bits - BLOCK_BITS), np.uint8)
    with tidy(counts.sparkSession):  # holds for queries that are made and end here
        blocks = counts.select("key", "n").mapInArrow(sparse, "block long, entries binary").groupBy("block").applyInArrow(dense, "block long, cells binary")
        found = blocks.collect()  # at most 64 MB in all
    for row in found:
        at = row["block"] * size
        cells[at : at + size] = np.frombuffer(zlib.decompress(row["cells"]), np.uint8)
    return Table(cells, bits, members)


def parted(rows: DataFrame, column: str, ids: DataFrame, n_ids: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose `column` may be among ids (one column of distinct whole numbers), and the others, which surely aren't
    and needn't be shuffled (None where ids are too many to tell). Null is not among them."""
    if not fits(n_ids, members=True):
        return rows, None
    table = build(ids.select(F.col(ids.columns[0]).alias("key"), F.lit(2).cast("long").alias("n")), n_ids, members=True)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def part(wanted: bool):
        def work(batches):
            for batch in batches:
                there = look_up(shared.value, batch[column].fill_null(0).to_numpy()) > 0
                there &= batch[column].is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(there == wanted))

        return rows.mapInArrow(work, rows.schema)

    return part(True), part(False)
