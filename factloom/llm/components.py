"""Connected components of a distributed graph by contraction.

A graph of at most `SMALL` edges is finished by union-find in one task, whose memory that number bounds. A larger
one is contracted until it is that small. In each round every node goes to that of its neighbours and itself with the least random rank, and the edges
are rewritten to the nodes that are left. Ranks change with the round, so chains shrink as fast as stars. The
rounds' maps are written to the shared folder; at the end they are composed, and each component takes its
smallest node as its name. Nothing of the graph comes to the driver but counts of edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise, merged, released

#: Edges that one task takes: some ten megabytes.
SMALL = 300_000


def least_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, and the smallest node that each is connected to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = list(range(len(nodes)))
    for i, j in zip(ends[: len(a)].tolist(), ends[len(a) :].tolist(), strict=True):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        while root[j] != j:
            root[j] = root[root[j]]
            j = root[j]
        if i != j:
            root[max(i, j)] = min(i, j)
    for i in range(len(root)):  # a root is never after its nodes
        root[i] = root[root[i]]
    return nodes, nodes[root]


def stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same components with every node linked to the smallest of its own: such a graph contracts at once."""
    if not links:
        return []
    a, b = (np.array(x, np.int64) for x in zip(*links, strict=True))
    nodes, roots = least_roots(a, b)
    return [(x, y) for x, y in zip(nodes.tolist(), roots.tolist(), strict=True) if x != y]


def _finished(edges: DataFrame) -> DataFrame:
    def solve(batches):
        parts = [(x["a"].to_numpy(), x["b"].to_numpy()) for x in batches]
        if parts:
            nodes, roots = least_roots(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "to"])
            del parts, nodes, roots
            released()

    return edges.repartition(1).mapInArrow(solve, "node long, to long")


def connected_components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """node, component (the smallest node of it) for every node in edges(a long, b long); loops are allowed."""
    # Once each before they are written: the same two nodes may have met at many places.
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    left = edges.where("a <> b")
    maps: list[DataFrame] = []
    while True:
        left = materialise(left, f"contracted-{len(maps)}")
        n = left.count()
        if n and n <= small:
            maps.append(materialise(_finished(left), "finished"))
        if n <= small:
            break
        rank = F.xxhash64("b", F.lit(len(maps)))
        both = left.union(left.select("b", "a"))
        best = both.groupBy("a").agg(F.min(F.struct(rank.alias("rank"), F.col("b").alias("node"))).alias("best"))
        own = F.struct(F.xxhash64("a", F.lit(len(maps))).alias("rank"), F.col("a").alias("node"))
        step = materialise(best.select(F.col("a").alias("node"), F.least("best", own)["node"].alias("to")), f"map-{len(maps)}")
        maps.append(step)
        at_a = merged(left, step.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
        at_b = merged(at_a, step.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
        left = at_b.where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
    found = nodes.select("node", F.col("node").alias("root"))
    for step in maps:
        found = merged(found, step.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    if not maps:
        return found.select("node", F.col("root").alias("component"))
    if n and len(maps) == 1:  # no round before: the roots are the smallest nodes themselves
        return found.select("node", F.col("root").alias("component"))
    found = materialise(found, "roots")
    names = found.groupBy("root").agg(F.min("node").alias("component"))
    return merged(found, names, "root").select("node", "component")
