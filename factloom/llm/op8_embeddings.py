"""Operator 8, embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact reranking.

Equal vectors of a label are one node. Rotations that give balanced binary codes are learned by iterative
quantisation (Gong and Lazebnik, 2011) from a sample of at most `sample` nodes of a length (the first by a hash); every
node is coded and indexed. The code is cut into substrings, each the key of a Hamming table: codes that differ in fewer
bits than there are tables share a substring (Norouzi, Punjani and Fleet, 2012). Nodes that share one within a label meet,
and their cosine is computed from the vectors in double precision. How many tables there are is measured, not assumed:
sample vectors get partners at the threshold exactly, in directions of all kinds, and tables are added until the share of
these pairs that meet is `recall` (pairs nearer than the threshold meet more often). Vectors are coded about their mean
or, where a strong common mean makes partners too alike in that, about the origin: whichever lets fewer others meet. The
number of bits a table follows the largest label, so buckets keep their size. Buckets of more than `most` nodes are dealt
out by pairs of blocks. A pair counts in the first table in which it meets. Vectors of lengths beyond the eight most
frequent are coded by random rotations about the origin.

A vector that is null, empty or zero, holds a null or non-finite component, or has a null label links with
nothing. Vectors of different lengths never link. Repeated rows are vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.cells import deal
from factloom.llm.common import materialise, runs
from factloom.llm.components import connected_components


#: Vectors of the sample that one rotation is learned from, and what sending a vector to a table costs, in meetings.
LEARN, MOVE = 5000, 10


def nodes_of(rows: DataFrame) -> DataFrame:
    """vec_id, label, sig (of label and vector; null if it links with nothing), vector (bytes of its numbers) for every row."""
    wide = rows.schema["embedding"].dataType.elementType.typeName() != "float"

    def work(batches):
        for batch in batches:
            lists = batch["embedding"]
            size = pc.list_value_length(lists).fill_null(0).to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64 if wide else np.float32) + 0  # null: NaN; -0: 0
            ends = np.cumsum(size)
            sigs, vectors = [], []
            for a, b, label in zip((ends - size).tolist(), ends.tolist(), batch["label"].to_pylist(), strict=True):
                x = flat[a:b]
                ok = label is not None and len(x) and np.isfinite(x).all() and x.any()
                vectors.append(x.tobytes() if ok else None)
                sigs.append(hashlib.blake2b(vectors[-1] + str(label).encode(), digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"].cast(pa.string()), pa.array(sigs, pa.binary()), pa.array(vectors, pa.binary())], ["vec_id", "label", "sig", "vector"])

    return rows.select("vec_id", "embedding", "label").mapInArrow(work, "vec_id long, label string, sig binary, vector binary")


def unpacked(vectors, width: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = np.frombuffer(b"".join(vectors), np.float64 if width == 8 else np.float32).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def learn_rotation(x: np.ndarray, seed: int, centred: bool = True, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Centre, and a matrix that takes centred vectors to those whose signs are the code."""
    centre = x.mean(axis=0) if centred else np.zeros(x.shape[1])
    x = x - centre
    r, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((x.shape[1],) * 2))
    if not centred:  # balance would turn the axes to the mean, where all vectors are alike
        return centre, r
    _, axes = np.linalg.eigh(x.T @ x)
    v = x @ axes
    for _ in range(steps):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return centre, axes @ r


def partners(x: np.ndarray, threshold: float, seed: int) -> np.ndarray:
    """For each unit vector one whose cosine with it is the threshold: a random one, or on the way to another vector."""
    rng = np.random.default_rng(seed)
    to = rng.standard_normal(x.shape)
    some = rng.random(len(x)) < 0.5
    to[some] = x[rng.integers(0, len(x), int(some.sum()))] + 1e-9 * to[some]
    to -= (to * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(to, axis=1, keepdims=True)
    return threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * to / np.where(norm > 0, norm, 1)


def plan_bits(largest: int, dim: int, bucket: int = 32) -> int:
    return int(min(max(1, dim), 24, max(8, math.ceil(math.log2(max(1, largest) / bucket)))))


def plan_tables(x: np.ndarray, bits: int, largest: int, threshold: float, recall: float, trials: int = 4000) -> tuple[list, int]:
    """Rotations and how many tables of that many bits, for unit vectors like these.

    Of the two ways to code, about the origin and about the mean, the one in which a vector of a label of `largest` costs
    less: it meets so many others, and is sent to so many tables (sending is reckoned as MOVE meetings).
    """
    rng = np.random.default_rng(0)
    order = rng.permutation(len(x))
    apart = len(x) // 2 if len(x) >= 200 else 0  # measured on vectors that the rotations weren't learned from
    learn, tried = x[order[apart:][:LEARN]], x[order[: apart or len(x)]]
    some, other = (tried[rng.integers(0, len(tried), trials)] for _ in range(2))
    near = partners(some, threshold, 1)
    per = x.shape[1] // bits
    best, least = None, math.inf
    for centred in (False, True):
        rotations, met, n, cost = [], np.zeros(trials, bool), 0, 0.0
        while met.mean() < recall and cost < least:
            if n % per == 0:
                rotations.append(learn_rotation(learn, len(rotations), centred))
                centre, turn = rotations[-1]
                a, b, c = ((v - centre) @ turn >= 0 for v in (some, near, other))
            at = slice(n % per * bits, (n % per + 1) * bits)
            met |= (a[:, at] == b[:, at]).all(axis=1)
            cost += (a[:, at] == c[:, at]).all(axis=1).mean() * largest + MOVE
            n += 1
        if cost < least:
            best, least = (rotations, n), cost
    return best


def code(x: np.ndarray, rotations: list, bits: int, tables: int) -> np.ndarray:
    """The tables' substrings (tables columns) of normalised vectors."""
    per = x.shape[1] // bits
    out = np.empty((len(x), tables), np.int64)
    for k, (c, r) in enumerate(rotations):
        signs = (x - c) @ r >= 0
        for t in range(k * per, min(tables, (k + 1) * per)):
            at = (t - k * per) * bits
            out[:, t] = signs[:, at : at + bits] @ (1 << np.arange(bits))
    return out


def random_plan(dim: int, threshold: float, recall: float) -> tuple[list, int, int]:
    """Rotations, bits and tables for vectors of which there is no sample: about the origin a bit differs as the angle says."""
    bits = plan_bits(1, dim)
    share = math.acos(min(1.0, threshold)) / math.pi
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - (1 - share) ** bits)))
    return [learn_rotation(np.zeros((1, dim)), seed, False) for seed in range(-(-tables // (dim // bits)))], bits, tables


def coded(nodes: DataFrame, plans: dict[int, tuple[list, int, int]], width: int, threshold: float, recall: float) -> DataFrame:
    """vec_id, copies, vector, codes, and key (of label, length, table and substring), one row for each table."""
    shared = nodes.sparkSession.sparkContext.broadcast(plans)

    def work(batches):
        for batch in batches:
            vectors, labels = batch["vector"].to_pylist(), batch["label"].to_pylist()
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_dim.setdefault(len(v) // width, []).append(i)
            for dim, rows in by_dim.items():
                x = unpacked([vectors[i] for i in rows], width)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                codes = code(x, *(shared.value.get(dim) or random_plan(dim, threshold, recall)))
                keys = [f"{labels[i]}|{dim}|{t}|{c}" for i, cs in zip(rows, codes.tolist(), strict=True) for t, c in enumerate(cs)]
                n = codes.shape[1]
                take = pa.array(np.repeat(np.array(rows), n))
                packed = pa.array([c.tobytes() for c in codes.astype(np.int32)], pa.binary()).take(pa.array(np.repeat(np.arange(len(rows)), n)))
                yield pa.RecordBatch.from_arrays([batch["vec_id"].take(take), batch["copies"].take(take), batch["vector"].take(take), packed, pa.array(np.tile(np.arange(n), len(rows))), pa.array(keys)], ["vec_id", "copies", "vector", "codes", "number", "key"])

    return nodes.select("vec_id", "copies", "label", "vector").mapInArrow(work, "vec_id long, copies long, vector binary, codes binary, number long, key string")


def rerank(dealt: DataFrame, threshold: float, width: int) -> DataFrame:
    """vec_id, links, other: links found for a node in a cell, and one node that it is linked to or connected with."""

    def work(batches):
        for table in runs(batches, "cell"):
            x = unpacked(table["vector"].to_pylist(), width)
            codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.int32).reshape(len(x), -1)
            number = table["number"][0].as_py()
            ids, copies = table["vec_id"].to_numpy(), table["copies"].to_numpy()
            side = table["side"].to_pylist()
            norm = np.sqrt((x * x).sum(axis=1))
            m = len(x)
            links, root = np.zeros(m, np.int64), np.arange(m)
            for a in range(0, m, 512):
                cos = (x[a : a + 512] @ x[a:].T) / np.outer(norm[a : a + 512], norm[a:])
                i, j = np.nonzero(cos >= threshold)
                i, j = i + a, j + a
                fit = (i < j) & (ids[i] != ids[j])
                if side[0] is not None:
                    flag = np.array(side, bool)
                    fit &= flag[i] != flag[j]
                i, j = i[fit], j[fit]
                fit = ~(codes[i, :number] == codes[j, :number]).any(axis=1)
                i, j = i[fit], j[fit]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                # Only an edge between two trees joins them; the labels stay the least position of a tree.
                while len(i):
                    apart = root[i] != root[j]
                    i, j = i[apart], j[apart]
                    if len(i):
                        p, q = sorted((root[i[0]], root[j[0]]))
                        star = i == i[0]
                        gone = np.unique(np.r_[q, root[j[star]], root[i[0]]])
                        p = gone.min()
                        root[np.isin(root, gone)] = p
            met = np.flatnonzero(links)
            if len(met):
                yield pa.RecordBatch.from_arrays([pa.array(ids[met]), pa.array(links[met]), pa.array(ids[root[met]])], ["vec_id", "links", "other"])

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(work, "vec_id long, links long, other long")


def near_vectors(rows: DataFrame, threshold: float = 0.93, recall: float = 0.98, sample: int = 20_000, most: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept (vec_id is its component's smallest) of every row."""
    every = materialise(nodes_of(rows), "vectors")
    width = 8 if rows.schema["embedding"].dataType.elementType.typeName() != "float" else 4
    nodes = every.where("sig IS NOT NULL").groupBy("sig").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    nodes = materialise(nodes.where("vec_id IS NOT NULL"), "distinct-vectors")
    dim = (F.length("vector") / width).cast("int")
    sizes = nodes.groupBy("label", dim.alias("dim")).agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("largest"), F.sum("n").alias("n"))
    plans = {}
    for r in sizes.orderBy(F.desc("n"), "dim").limit(8).collect():
        taken = nodes.where(dim == r["dim"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toPandas()
        x = unpacked(taken["vector"].tolist(), width)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        bits = plan_bits(r["largest"], r["dim"])
        rotations, tables = plan_tables(x, bits, r["largest"], threshold, recall)
        plans[r["dim"]] = rotations, bits, tables
    met = materialise(rerank(deal(coded(nodes, plans, width, threshold, recall), "key", "vec_id", most), threshold, width), "links")
    comps = connected_components(met.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    links = met.groupBy("vec_id").agg(F.sum("links").alias("links")).join(comps, F.col("vec_id") == F.col("node")).drop("node")
    known = nodes.join(links, "vec_id", "left").select("sig", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    known = known.where("n_links > 0")
    out = every.select("vec_id", "sig").join(known, "sig", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
