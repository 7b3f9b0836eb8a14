"""Operator 2, n-gram Jaccard join over prefix trees.

A document is the set of its distinct word n-grams (hashed to 62 bits over prime fields); documents of equal sets, by a
128-bit digest, are one node. Two nodes with Jaccard similarity t or more share most of their least n-grams by hash, so
each node keeps a prefix of 2m + 1 of these, m being the n-grams it may have beyond a partner. Of the prefix, the n-grams
that are rarest among all prefixes are enough to meet every partner (the order is one for the whole corpus: the class of
the count, then the hash). Nodes that meet are gathered in groups, and each group's whole sets, of n-grams numbered by
their words, are joined over a prefix tree (triejoin). A group of more than `block` n-grams is dealt out by pairs of
blocks, so that a task's memory is bounded. Links that the groups find are spanning forests, never all pairs, and a last
pass turns them into components. A pair at the threshold exactly is linked; ties of counts are broken by the hash.

Null texts and texts without words have an empty set, link with nothing and are components of their own.
Rows that repeat a doc_id are one node of the graph and are returned each. A null doc_id is returned with a
component of its equals, if any, or null. Very long texts are taken whole. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm import sketch
from factloom.llm.common import materialise, runs, slices
from factloom.llm.components import connected_components, stars
from factloom.llm.textkernel import shingle_sets
from factloom.llm.triejoin import join_group


def spare(n, num: int, den: int):
    """How many of n n-grams can be missing from a partner."""
    return n - -(-num * n // den)


def prefix_length(n, num: int, den: int):
    return np.minimum(n, 2 * spare(n, num, den) + 1)


def probe_length(n, num: int, den: int):
    """How many of the prefix, rarest first, meet every partner."""
    return prefix_length(n, num, den) - spare(-(-num * n // den), num, den)


def _list_column(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def document_sets(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, sig (a digest of the set; null if empty), prefix."""

    def work(batches):
        for batch in slices(batches, "text"):
            flat, ends = shingle_sets(batch["text"], words)
            n = np.diff(ends)
            take = prefix_length(n, num, den)
            within = np.arange(len(flat)) - np.repeat(ends[:-1], n)
            kept = flat[within < np.repeat(take, n)]
            sig = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            prefix = _list_column(kept, np.r_[0, np.cumsum(take)])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(sig, pa.binary()), prefix], ["doc_id", "n_shingles", "sig", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_shingles long, sig binary, prefix array<long>")


def probes(nodes: DataFrame, counts: DataFrame, n_keys: int, num: int, den: int) -> DataFrame:
    """key, doc_id, n_shingles for the probing n-grams of each node that other nodes have too.

    Counts are looked up in a table of bounded size, or joined where that would be too small for them.
    """
    if not sketch.fits(n_keys):
        size = F.col("n_shingles")
        least = F.ceil(size * num / den)  # of the smallest partner
        most = F.least(size, 2 * (size - least) + 1) - (least - F.ceil(least * num / den))
        rows = nodes.select("doc_id", "n_shingles", F.explode("prefix").alias("key")).join(counts, "key", "left")
        kind = F.when(F.col("n").isNull(), 0).otherwise(1 + F.floor(F.log2("n")))
        rows = rows.withColumn("kind", kind).withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("kind", "key")))
        return rows.where((F.col("place") <= most) & (F.col("kind") > 0)).select("key", "doc_id", "n_shingles")
    shared = nodes.sparkSession.sparkContext.broadcast(sketch.build(counts, n_keys))

    def work(batches):
        for batch in batches:
            prefix = batch["prefix"]
            key = prefix.flatten().to_numpy()
            length = np.diff(prefix.offsets.to_numpy())
            row = np.repeat(np.arange(len(length)), length)
            kind = sketch.look_up(shared.value, key)
            order = np.lexsort((key, kind, row))
            within = np.arange(len(key)) - np.repeat(np.r_[0, np.cumsum(length)][:-1], length)
            most = probe_length(batch["n_shingles"].to_numpy(), num, den)
            order = order[(within < most[row]) & (kind[order] > 0)]
            take = pa.array(row[order])
            yield pa.RecordBatch.from_arrays([pa.array(key[order]), batch["doc_id"].take(take), batch["n_shingles"].take(take)], ["key", "doc_id", "n_shingles"])

    return nodes.select("doc_id", "n_shingles", "prefix").mapInArrow(work, "key long, doc_id long, n_shingles long")


def meetings(met: DataFrame, num: int, den: int) -> DataFrame:
    """Edges a, b that connect the nodes of each key in met(key, doc_id, n_shingles) whose sizes allow a link.

    Sizes are parted by bands as wide as a link allows; nodes that can be linked lie in the same band or in neighbours,
    so they meet in one of two pairings of the bands. Without the bands, chance meetings of texts of all sizes would tie
    ever more of the corpus into one group.
    """
    size = F.col("n_shingles").cast("double")
    band = F.floor(F.log(size) / F.log(F.lit(den / num)) + 1e-9) if num < den else size
    pair = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.floor((F.col("band") + p) / 2).alias("q")) for p in (0, 1)]))
    rows = met.withColumn("band", band).select("key", "doc_id", pair.alias("pair")).select("key", "doc_id", "pair.p", "pair.q")
    first = rows.groupBy("key", "p", "q").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").drop("last")
    return rows.join(first, ["key", "p", "q"]).where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))


def exact_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text as numbers that are equal only for equal shingles of these texts."""
    seen: dict[bytes, int] = {}
    short: dict[tuple, int] = {}
    rows = []
    for text in texts:
        row = (text or b"").lower().split()
        rows.append(np.fromiter((seen.setdefault(w, len(seen)) for w in row), np.int64, len(row)))
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    n = np.maximum(0, size - words + 1)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    first = np.repeat(np.r_[0, np.cumsum(size)][:-1], n) + np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n)
    bits = width = len(seen).bit_length()
    value = flat[first]
    for j in range(1, words):
        if bits + width > 62:  # number the prefixes anew, so that the next word has room
            value = np.unique(value, return_inverse=True)[1].astype(np.int64)
            bits = len(value).bit_length()
        value = value << width | flat[first + j]
        bits += width
    ends = np.cumsum(n)
    out = []
    for i, row in enumerate(rows):
        if n[i]:
            out.append(np.unique(value[ends[i] - n[i] : ends[i]]))
        elif len(row):
            out.append(np.array([-1 - short.setdefault(tuple(row.tolist()), len(short))], np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def links_in_cells(placed: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Edges a, b to the smallest node of each connected part in the cells of placed(cell, side, doc_id, text), whose rows of a cell are met in one task.

    Sets are made anew from the texts, of shingles numbered by their words: no hash has a say in what is linked.

    side is null if all of a cell are to be joined, else which of its two blocks a row belongs to.
    """

    def work(batches):
        for table in runs(batches, "cell"):
            ids = table["doc_id"].to_pylist()
            sets = exact_sets(table["text"].cast(pa.large_binary()).to_pylist(), words)
            side = table["side"].to_pylist()
            full = [i for i, s in enumerate(sets) if len(s)]
            cross = None if side[0] is None else np.array([side[i] for i in full], bool)
            found = stars([(ids[full[i]], ids[full[j]]) for i, j in join_group([sets[i] for i in full], num, den, cross)])
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return placed.repartition("cell").sortWithinPartitions("cell").mapInArrow(work, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, block: int = 250_000) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of each row of docs."""
    if 2 * num < den:
        raise ValueError("the prefixes are right for similarities of a half or more")
    docs = docs.select("doc_id", "text")
    every = materialise(document_sets(docs, words, num, den), "sets")
    narrow = every.select("doc_id", "n_shingles", "sig")
    equal = narrow.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    nodes = materialise(every.join(equal.select("sig", F.col("rep").alias("doc_id")), ["sig", "doc_id"]).dropDuplicates(["sig", "doc_id"]), "nodes")
    counts = nodes.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    counts = materialise(counts, "ngram-counts")
    n_keys = counts.count()
    found = None
    if n_keys:
        met = materialise(probes(nodes, counts, n_keys, num, den), "probes")
        groups = materialise(connected_components(meetings(met, num, den)), "groups")
        n_met = groups.count()
        if n_met:
            found = _linked(docs, nodes, groups, n_met, words, num, den, block)
    result = narrow
    if found is None:
        known = equal.where("copies > 1").select("sig", F.col("rep").alias("component"))
    else:
        known = equal.join(found, equal["rep"] == found["node"], "left").where("copies > 1 OR component IS NOT NULL").select("sig", F.coalesce("component", "rep").alias("component"))
    return result.join(known, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _linked(docs, nodes, groups, n_met, words, num, den, block) -> DataFrame:
    """node, component of the nodes that have links."""
    sized = groups.join(nodes.groupBy(F.col("doc_id").alias("node")).agg(F.sum("n_shingles").alias("n")), "node")
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(block)).alias("blocks"))
    blocks = materialise(blocks, "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    many = F.col("blocks") > 1
    pair = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda q: F.struct(F.least("own", q).alias("i"), F.greatest("own", q).alias("j"))))
    placed = groups.join(blocks, "component").withColumn("own", own).withColumn("pair", pair)
    placed = placed.select(
        F.col("node").alias("doc_id"),
        F.concat_ws("/", "component", "pair.i", "pair.j").alias("cell"),
        F.when(many & F.expr("pair.i <> pair.j"), F.col("own") == F.col("pair.i")).alias("side"),
    )
    texts, _ = sketch.parted(docs, "doc_id", groups.select("node"), n_met)
    links = links_in_cells(placed.join(texts, "doc_id"), words, num, den)
    return connected_components(links)
