"""Groups of near-identical texts and vectors by Ward linkage, at any size of a page or label."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.urls import bind
from factloom.operators.scratch import kept
from factloom.session import ship

#: Edges that are clustered in one call on average; those of one page or label stay together.
GROUP = 50_000
#: Pages of up to so many texts have them paired directly; those of more are paired by their segments.
FEW = 32


def ward(distance: np.ndarray, cut: float, sizes: list[int] | None = None) -> list[list[int]]:
    """Clusters after all merges of height up to cut, from a square matrix of distances.

    Nearest-neighbour chains (Murtagh, 1983) with the update of Lance and Williams (1967): quadratic in time, and in place. A point
    whose nearest neighbour is beyond the cut never comes nearer to any, as no merge up to the cut makes a distance to a
    third point less than both were, if these exceed it; so it is finished. sizes: how many equal points each row stands for.
    """
    n = np.ones(len(distance)) if sizes is None else np.asarray(sizes, float)
    d = distance.astype(float) ** 2 * (2 * np.outer(n, n) / np.add.outer(n, n))
    np.fill_diagonal(d, np.inf)
    groups = {i: [i] for i in range(len(d))}
    out, chain = [], []
    while groups:
        if not chain:
            chain.append(next(iter(groups)))
        i = chain[-1]
        j = int(np.argmin(d[i]))
        if len(chain) > 1 and d[i, chain[-2]] <= d[i, j]:
            j = chain[-2]
        if not d[i, j] <= cut**2:
            out.append(groups.pop(chain.pop()))
            d[i], d[:, i] = np.inf, np.inf
        elif len(chain) > 1 and j == chain[-2]:
            del chain[-2:]
            i, j = min(i, j), max(i, j)
            joined = ((n[i] + n) * d[i] + (n[j] + n) * d[j] - n * d[i, j]) / (n[i] + n[j] + n)
            d[i], d[:, i] = joined, joined
            d[j], d[:, j] = np.inf, np.inf
            d[i, i] = np.inf
            n[i] += n[j]
            groups[i] += groups.pop(j)
        else:
            chain.append(j)
    return sorted(sorted(g) for g in out)


def ward_vectors(x: np.ndarray, cut: float, sizes: list[int] | None = None) -> list[list[int]]:
    """ward of the Euclidean distances of x's rows, without their matrix: the height of two clusters follows from their means."""
    n = np.ones(len(x)) if sizes is None else np.asarray(sizes, float)
    mean, square = x.astype(float), (x.astype(float) ** 2).sum(1)
    alive = np.ones(len(x), bool)
    groups = {i: [i] for i in range(len(x))}
    out, chain = [], []

    def heights(i: int, others: np.ndarray) -> np.ndarray:
        return 2 * n[i] * n[others] / (n[i] + n[others]) * ((mean[others] - mean[i]) ** 2).sum(1)

    while groups:
        if not chain:
            chain.append(next(iter(groups)))
        i = chain[-1]
        rough = square + square[i] - 2 * mean @ mean[i]  # near ones are taken again from the differences
        rough *= 2 * n[i] * n / (n[i] + n)
        rough[~alive] = np.inf
        rough[i] = np.inf
        near = np.flatnonzero(rough <= rough.min() + 1e-9 * (1 + square[i] + square.max()) * n.max())
        near = near[np.isfinite(rough[near])]
        d = np.full(len(x), np.inf)
        d[near] = heights(i, near)
        d[i] = np.inf
        j = int(np.argmin(d))
        if len(chain) > 1 and heights(i, np.array([chain[-2]]))[0] <= d[j]:
            j = chain[-2]
        if not d[j] <= cut**2:
            out.append(groups.pop(chain.pop()))
            alive[i] = False
        elif len(chain) > 1 and j == chain[-2]:
            del chain[-2:]
            i, j = min(i, j), max(i, j)
            mean[i] = (n[i] * mean[i] + n[j] * mean[j]) / (n[i] + n[j])
            square[i] = (mean[i] ** 2).sum()
            n[i] += n[j]
            alive[j] = False
            groups[i] += groups.pop(j)
        else:
            chain.append(j)
    return sorted(sorted(g) for g in out)


def parts_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For the links a[i] - b[i] between numbers below n: the smallest number that each can reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for x in (root[a], root[b], a, b):
            np.minimum.at(new, x, low)
        while not np.array_equal(up := new[new], new):
            new = up
        if np.array_equal(new, root):
            return root
        root = new


def segment_keys(text: Column, cut: int) -> Column:
    """(place, length, segment) of the cut + 1 segments of a text: any text within cut edits holds one of them unchanged."""
    n = F.length(text)
    start = lambda i: F.floor(i * n / (cut + 1)).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(cut)), lambda i: F.struct(i.cast("int").alias("place"), n.alias("size"), F.substr(text, start(i) + 1, start(i + 1) - start(i)).alias("segment")))


def probe_keys(text: Column, cut: int) -> Column:
    """(place, length, segment) under which texts of `text`'s length or up to cut less may be found within cut edits.

    Before the segment there are at most cut edits, so it begins at most cut places away from where it was.
    """
    n = F.length(text)
    sizes = F.filter(F.sequence(n - cut, n), lambda size: size > 0)

    def of(size: Column, i: Column) -> Column:
        start = F.floor(i * size / (cut + 1)).cast("int")
        long = F.floor((i + 1) * size / (cut + 1)).cast("int") - start
        first, last = F.greatest(F.lit(0), start - cut), F.least(n - long, start + cut)
        key = lambda at: F.struct(i.cast("int").alias("place"), size.alias("size"), F.substr(text, at + 1, long).alias("segment"))
        return F.when(first <= last, F.transform(F.sequence(first, last), key)).otherwise(F.array().cast("array<struct<place: int, size: int, segment: string>>"))

    return F.array_distinct(F.flatten(F.flatten(F.transform(sizes, lambda size: F.transform(F.sequence(F.lit(0), F.lit(cut)), lambda i: of(size, i))))))


def without_common_start(a: Column, b: Column, chunk: int = 64) -> Column:
    """struct(a, b) without the chunks in which both begin alike: what is left has the same edit distance."""
    whole = F.floor(F.least(F.length(a), F.length(b)) / chunk).cast("int")
    piece = lambda x, i: F.substr(x, (i - 1) * chunk + 1, F.lit(chunk))
    first = F.get(F.filter(F.sequence(F.lit(1), whole), lambda i: piece(a, i) != piece(b, i)), F.lit(0))
    alike = F.when(whole < 1, 0).otherwise(F.coalesce(first - 1, whole))
    return bind(alike, lambda k: F.struct(F.substr(a, k * chunk + 1, F.length(a)).alias("a"), F.substr(b, k * chunk + 1, F.length(b)).alias("b")))


def edit_distance(a: str, b: str, cut: int | None = None, long: int = 256) -> Column:
    """The edit distance; -1 beyond the cut. Of long texts only what lies between common beginnings and ends is compared."""

    def d(x: Column, y: Column) -> Column:
        return F.levenshtein(x, y) if cut is None else F.levenshtein(x, y, cut)

    middle = bind(without_common_start(F.col(a), F.col(b)), lambda s: without_common_start(F.reverse(s["a"]), F.reverse(s["b"])))
    return F.when(F.least(F.length(a), F.length(b)) < long, d(F.col(a), F.col(b))).otherwise(bind(middle, lambda s: d(s["a"], s["b"])))


def near_texts(texts: DataFrame, cut: int, few: int = FEW) -> DataFrame:
    """url, id_a, id_b, d of the pairs of one page's texts(url, id, claim) with an edit distance d up to cut, id_a < id_b.

    Distances stop counting at the cut. Texts of a page with many are paired only if they share a segment, at its place give or
    take the cut; very short ones (no longer than 2 * cut, whose segments say little) are few by nature and paired by length.
    """
    spark = texts.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but much to compute: not to be put together
    counted = texts.join(texts.groupBy("url").agg(F.count("*").alias("n_texts")).where("n_texts > 1"), "url")
    sides = lambda rows, s: rows.select(F.col("url"), F.col("id").alias(f"id_{s}"), F.col("claim").alias(f"claim_{s}"), F.length("claim").alias(f"long_{s}"))
    met = counted.where(F.col("n_texts") <= few).repartition(spread, "url")
    met = sides(met, "a").join(sides(met, "b"), "url").where((F.col("id_a") < F.col("id_b")) & (F.abs(F.col("long_a") - F.col("long_b")) <= cut))
    large = kept(counted.where(F.col("n_texts") > few), "large")
    if not large.isEmpty():
        names, smaller = met.columns, "(long_a < long_b OR long_a = long_b AND id_a < id_b) AND long_b - long_a <= " + str(cut)
        low = sides(large.where(F.length("claim") <= 2 * cut), "a").withColumn("size", F.explode(F.sequence(F.col("long_a"), F.col("long_a") + cut)))
        by_length = low.join(sides(large.where(F.length("claim") <= 3 * cut), "b").withColumn("size", F.col("long_b")), ["url", "size"]).where(smaller)
        long = large.where(F.length("claim") > 2 * cut)
        index = long.select("url", F.col("id").alias("id_a"), F.explode(segment_keys(F.col("claim"), cut)).alias("k"))
        probes = long.select("url", F.col("id").alias("id_b"), F.explode(probe_keys(F.col("claim"), cut)).alias("k"))
        ids = index.join(probes, ["url", "k"]).where("id_a <> id_b").select("url", "id_a", "id_b").distinct()
        by_segment = ids.join(sides(large, "a"), ["url", "id_a"]).join(sides(large, "b"), ["url", "id_b"]).where(smaller)
        met = met.select(names).unionByName(by_length.select(names)).unionByName(by_segment.select(names).repartition(spread))
    decided = kept(met.select("url", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), edit_distance("claim_a", "claim_b", cut).alias("d")), "near")
    return decided.where("d >= 0")


def ward_parts(edges: DataFrame, sizes: DataFrame, distance, cut: float, of_points=None) -> DataFrame:
    """id, cluster (its smallest id) of points that have others within the cut: Ward's clusters, part by part.

    edges(url, id_a, id_b, d): all pairs of a group up to the cut; sizes(id, n): how many equal points each stands for. Points that
    no chain of such edges connects never come into one cluster, so a part is done by itself. Where a part has all its pairs
    among the edges it is done at once; for others distance(pairs(id_a, id_b)) gives the distances of the missing pairs alone. of_points(points(id, part, n)) does
    such parts instead without a row for each pair, where there is a way.
    """
    ship(edges.sparkSession)
    groups = max(1, edges.count() // GROUP)
    hashed = edges.select(F.pmod(F.xxhash64("url"), F.lit(groups)).alias("k"), "id_a", "id_b", F.col("d").cast("double").alias("d"))
    linked = hashed.join(sizes.select(F.col("id").alias("id_a"), F.col("n").alias("n_a")), "id_a").join(sizes.select(F.col("id").alias("id_b"), F.col("n").alias("n_b")), "id_b")

    def columns(table: pa.Table) -> tuple[np.ndarray, ...]:
        """The points' ids in order, their weights, and each pair as places among them with its distance."""
        a, b, d, n_a, n_b = (table[c].to_numpy() for c in ("id_a", "id_b", "d", "n_a", "n_b"))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        i, j = at[: len(a)], at[len(a) :]
        weight = np.ones(len(ids), np.int64)
        weight[i], weight[j] = n_a, n_b
        return ids, weight, i, j, d

    def of_group(table: pa.Table) -> pa.Table:
        """A row for each point; without a cluster where pairs of its part are missing."""
        ids, weight, i, j, d = columns(table)
        part = parts_of(i, j, len(ids))
        order, of_part = np.argsort(part, kind="stable"), np.argsort(part[i], kind="stable")
        points = np.split(order, np.flatnonzero(np.diff(part[order])) + 1)
        links = np.split(of_part, np.flatnonzero(np.diff(part[i][of_part])) + 1)
        cluster = np.full(len(ids), -1)
        for members, own in zip(points, links, strict=True):
            if len(own) == len(members) * (len(members) - 1) // 2:
                cluster[members] = _clusters(members, i[own], j[own], d[own], weight, cut)
        return pa.table({"id": ids, "part": ids[part], "cluster": pa.array(ids[cluster], mask=cluster < 0), "n": weight})

    def of_part(table: pa.Table) -> pa.Table:
        ids, weight, i, j, d = columns(table)
        return pa.table({"id": ids, "cluster": ids[_clusters(np.arange(len(ids)), i, j, d, weight, cut)]})

    points = kept(linked.groupBy("k").applyInArrow(of_group, "id long, part long, cluster long, n long"), "parts")
    undone = points.where("cluster IS NULL")
    if of_points is not None:
        return points.where("cluster IS NOT NULL").select("id", "cluster").unionByName(of_points(undone.select("id", "part", "n")))
    pairs = undone.select(F.col("id").alias("id_a"), F.col("n").alias("n_a"), "part").join(undone.select(F.col("id").alias("id_b"), F.col("n").alias("n_b"), "part"), "part").where("id_a < id_b")
    known = pairs.join(hashed.select("id_a", "id_b", "d"), ["id_a", "id_b"], "left")
    full = distance(known.where("d IS NULL").drop("d")).unionByName(known.where("d IS NOT NULL"))
    rest = full.select("part", "id_a", "id_b", "n_a", "n_b", "d").groupBy("part").applyInArrow(of_part, "id long, cluster long")
    return points.where("cluster IS NOT NULL").select("id", "cluster").unionByName(rest)


def _clusters(members: np.ndarray, i: np.ndarray, j: np.ndarray, d: np.ndarray, weight: np.ndarray, cut: float) -> np.ndarray:
    """The smallest point of the cluster of each of the members (sorted), from the distances of all their pairs."""
    matrix = np.zeros((len(members), len(members)))
    x, y = np.searchsorted(members, i), np.searchsorted(members, j)
    matrix[x, y] = matrix[y, x] = d
    out = members.copy()
    for g in ward(matrix, cut, weight[members]):
        out[g] = members[g[0]]
    return out


def claim_clusters(reviews: DataFrame, cut: int = 5, few: int = FEW) -> DataFrame:
    """url, review_id, cluster (its smallest review_id): Ward clusters of a page's claims over their edit distances.

    Equal texts are one point with a weight. Only texts within the cut of each other make edges, and parts of a page that edges
    connect are clustered by themselves (ward_parts), so distances beyond the cut are taken inside such a part alone.
    Null claims are empty ones. Of a part, one task holds a matrix of its distinct texts.
    """
    rows = reviews.select("url", "review_id", F.trim(F.coalesce("claim_reviewed", F.lit(""))).alias("claim"))
    texts = kept(rows.groupBy("url", "claim").agg(F.min("review_id").alias("id"), F.count("*").alias("n")), "texts")

    def distance(pairs: DataFrame) -> DataFrame:
        claims = lambda s: texts.select(F.col("id").alias(f"id_{s}"), F.col("claim").alias(f"claim_{s}"))
        out = pairs.join(claims("a"), "id_a").join(claims("b"), "id_b")
        return out.withColumn("d", edit_distance("claim_a", "claim_b").cast("double")).drop("claim_a", "claim_b")

    joined = ward_parts(near_texts(texts, int(cut), few), texts.select("id", "n"), distance, cut)
    known = texts.join(joined, "id", "left").select("url", "claim", F.coalesce("cluster", "id").alias("cluster"))
    return rows.join(known, ["url", "claim"]).select("url", "review_id", "cluster")


def euclidean(x: str, y: str) -> Column:
    square = F.aggregate(F.zip_with(x, y, lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double"))), F.lit(0.0), lambda acc, v: acc + v)
    return F.sqrt(square)


def single_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The distances of rows of x and y in single precision, summed component by component; a square and its sum are rounded once."""
    apart = (x.astype(np.float32) - y.astype(np.float32)).astype(float)
    total = np.zeros(len(x), np.float32)
    for c in range(apart.shape[1]):
        total = (total + apart[:, c] ** 2).astype(np.float32)  # in doubles, which hold the square exactly
    return np.sqrt(total)


def embedding_pairs(rows: DataFrame, limit: float, block: int = 1000, single: bool = False, most: int = 50_000) -> DataFrame:
    """i < j of one label whose vectors(vec_id, label, embedding) are nearer than limit (Euclidean), and their distance.

    A label of more than `block` vectors is dealt out as pairs of blocks, three of them until they would have more than `most` vectors:
    a vector moves once a block. Each pair is done by matrix products of some rows at a time; near pairs alone leave it, and their distance is taken again from the vectors' differences. Vectors that are null meet nothing; those
    of one label have one length. single: whether a pair is near is decided in the precision of the vectors' components, as SQL's
    list_distance does, which matters for pairs at the limit alone.
    """
    ship(rows.sparkSession)
    whole = rows.where("embedding IS NOT NULL AND label IS NOT NULL").select("vec_id", "label", "embedding")
    counts = whole.groupBy("label").agg(F.greatest(F.least(F.ceil(F.count("*") / block), F.lit(3)), F.ceil(F.count("*") / most)).cast("int").alias("blocks"))
    dealt = whole.join(counts, "label").withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("label", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "vec_id", "embedding")

    def near(table: pa.Table) -> pa.Table:
        ids, own = table["vec_id"].to_numpy(), table["own"].to_numpy()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
        x = flat.reshape(len(ids), -1)
        left, right = own == low, own == high
        slack = (1e-5 + 2e-7 * x.shape[1]) * (limit + limit**2) if single else limit**2 * 1e-6 + 1e-6
        y, z = x[left], x[right]
        step, square, found = max(1, 4_000_000 // max(1, len(z))), (z**2).sum(1), [np.zeros((2, 0), np.int64)]
        for k in range(0, len(y), step):
            d = (y[k : k + step] ** 2).sum(1)[:, None] + square - 2 * y[k : k + step] @ z.T
            found.append(np.stack(np.nonzero(d < limit**2 + slack)) + np.array([[k], [0]]))  # a little more; decided below
        i, j = np.concatenate(found, axis=1)
        a, b = ids[left][i], ids[right][j]
        keep = a < b if low == high else a != b
        a, b, i, j = a[keep], b[keep], i[keep], j[keep]
        exact = np.sqrt(((x[left][i] - x[right][j]) ** 2).sum(1))
        keep = exact < limit
        if single:
            open_ = np.flatnonzero(np.abs(exact**2 - limit**2) < slack)
            keep[open_] = single_distance(x[left][i[open_]], x[right][j[open_]]) < np.float32(limit)
        return pa.table({"label": pa.repeat(table["label"][0], int(keep.sum())), "i": np.minimum(a, b)[keep], "j": np.maximum(a, b)[keep], "distance": exact[keep]})

    kind = rows.schema["label"].dataType.simpleString()
    return cells.groupBy("label", "low", "high").applyInArrow(near, f"label {kind}, i long, j long, distance double")


def embedding_clusters(rows: DataFrame, cut: float = 0.9) -> DataFrame:
    """vec_id, cluster (its smallest vec_id) of Ward clusters of two or more within a label, part by part (ward_parts)."""
    vectors = rows.select("vec_id", "embedding")
    edges = kept(embedding_pairs(rows, float(np.nextafter(cut, np.inf))).select(F.col("label").cast("string").alias("url"), F.col("i").alias("id_a"), F.col("j").alias("id_b"), F.col("distance").alias("d")), "near")

    def of_part(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table["id"].to_numpy()
        x = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        out = ids.copy()
        for g in ward_vectors(x, cut, table["n"].to_numpy()):
            out[g] = ids[g[0]]
        return pa.table({"id": ids, "cluster": out})

    def of_points(points: DataFrame) -> DataFrame:
        """Parts by their vectors: a row a point, where there would be one for each pair."""
        return points.join(vectors.select(F.col("vec_id").alias("id"), "embedding"), "id").groupBy("part").applyInArrow(of_part, "id long, cluster long")

    joined = ward_parts(edges, vectors.select(F.col("vec_id").alias("id"), F.lit(1).cast("long").alias("n")), None, cut, of_points)
    large = joined.groupBy("cluster").agg(F.count("*").alias("members")).where("members > 1").drop("members")
    return joined.join(large, "cluster").select(F.col("id").alias("vec_id"), "cluster")
