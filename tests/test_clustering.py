"""Clusters of claims and vectors against plain Ward linkage over all distances."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import clustering


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_ward(d, cut):
    """The nearest two clusters joined, again and again, heights from all distances between and within."""
    groups = [[i] for i in range(len(d))]

    def height(x, y):
        mean = lambda p, q: d[np.ix_(p, q)].__pow__(2).mean()
        return 2 * len(x) * len(y) / (len(x) + len(y)) * (mean(x, y) - mean(x, x) / 2 - mean(y, y) / 2)

    while len(groups) > 1:
        h, i, j = min((height(x, y), i, j) for i, x in enumerate(groups) for j, y in enumerate(groups) if i < j)
        if h > cut**2 + 1e-9:
            break
        groups[i] += groups.pop(j)
    return sorted(sorted(g) for g in groups)


def test_ward_against_plain():
    r = np.random.default_rng(1)
    for n in [1, 2, 3, 5, 8, 13, 20] * 6:
        x = r.normal(size=(n, 2)) * 3
        d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
        for cut in (0.5, 2.0, 6.0):
            assert clustering.ward(d, cut) == plain_ward(d, cut)


def test_ward_of_many_points_is_quick():
    x = np.random.default_rng(2).integers(0, 400, size=3000).astype(float)
    d = np.abs(x[:, None] - x)
    got = clustering.ward(d, 5.0)
    assert sorted(i for g in got for i in g) == list(range(3000)) and all(np.ptp(x[g]) <= 12 for g in got)


def test_parts():
    a, b = np.array([5, 1, 7, 3]), np.array([1, 3, 8, 3])
    assert clustering.parts_of(a, b, 9).tolist() == [0, 1, 2, 1, 4, 1, 6, 7, 7]
    n = 2000
    assert clustering.parts_of(np.arange(n - 1), np.arange(1, n), n).tolist() == [0] * n


def texts_of(seed, n):
    r = random.Random(seed)
    bases = ["", "a", "short one", "it rains in the town of the north", "the law of twenty twenty forbids all of this, they say, since May"]
    out = []
    for _ in range(n):
        t = list(r.choice(bases))
        for _ in range(r.randint(0, 6)):
            at = r.randint(0, len(t))
            t[at : at + r.randint(0, 1)] = r.choice(["x", "y", "é", "", " "])
        out.append("".join(t))
    return out


def clusters_of(texts, cut=5):
    d = np.array([[edits(a, b) for b in texts] for a in texts], float)
    return plain_ward(d, cut)


@pytest.mark.parametrize("few", [0, 32])
def test_near_texts_are_all_found(spark, few):
    texts = sorted({t.strip() for t in texts_of(3, 90)})
    rows = spark.createDataFrame([(p, i + 1000 * k, t) for k, p in enumerate("uv") for i, t in enumerate(texts)], "url string, id long, claim string")
    got = {(r.id_a, r.id_b): r.d for r in clustering.near_texts(rows, 5, few).collect() if r.url == "u"}
    want = {(i, j): d for i in range(len(texts)) for j in range(i + 1, len(texts)) if (d := edits(texts[i], texts[j])) <= 5}
    assert got == want


def test_claims_against_plain_ward(spark):
    """Distances between points and heights are alike in many places, so only pages without ties in the decision are compared."""
    rows, want = [], {}
    for page in range(40):
        texts = [t.strip() for t in texts_of(page, 7)]
        d = np.array([[edits(a, b) for b in texts] for a in texts], float)
        jitter = [plain_ward(d + np.where(d > 0, e * (np.arange(7)[:, None] + np.arange(7)), 0), 5) for e in (1e-6, -1e-6)]
        if jitter[0] != jitter[1] or jitter[0] != plain_ward(d, 5):
            continue
        rows += [(f"p{page}", 10 * page + i, t) for i, t in enumerate(texts)]
        want |= {10 * page + i: 10 * page + g[0] for g in jitter[0] for i in g}
    assert len(want) > 100
    cr = spark.createDataFrame(rows, "url string, review_id long, claim_reviewed string")
    for few in (0, 32):
        assert {r.review_id: r.cluster for r in clustering.claim_clusters(cr, few=few).collect()} == want


def test_a_page_of_many_texts(spark):
    """5,000 texts of one page: one template with numbers, and texts that chain without all being near."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(r.choices(words, k=12)) for _ in range(4000)] + [f"{'x' * i}{'the bill was passed at night'}" for i in range(0, 60, 3)] + [f"case {i:04d} closed" for i in range(980)]
    cr = spark.createDataFrame(list(enumerate(texts)), "review_id long, claim_reviewed string").withColumn("url", F.lit("u"))
    got = {x.review_id: x.cluster for x in clustering.claim_clusters(cr).collect()}
    assert len(got) == 5000 and sum(got[i] == i for i in range(4000)) > 3990
    chain = clusters_of(texts[4000:4020])
    assert len({got[i] for i in range(4000, 4020)}) == len(chain)
    sizes = {}
    for i in range(4020, 5000):
        sizes.setdefault(got[i], []).append(i)
    assert all(c >= 4020 for c in sizes) and max(map(len, sizes.values())) > 5


def test_edit_distance_of_long_texts(spark):
    r = random.Random(5)
    base = "".join(r.choices("abcdé \n", k=3000))
    pairs = [(base, base), (base, base + "!"), (base, "x" + base), (base[:700] + "QQ" + base[700:], base), (base, base[5:]), (base, base[:1500]), (base, base[:64]), ("", base), (base[:300], base[:299] + "zz")]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {x.i: (x.near, x.full) for x in rows.select("i", clustering.edit_distance("a", "b", 5).alias("near"), clustering.edit_distance("a", "b").alias("full")).collect()}
    want = [edits(a, b) if abs(len(a) - len(b)) < 10 else abs(len(a) - len(b)) for a, b in pairs]
    assert got == {i: (d if d <= 5 else -1, d) for i, d in enumerate(want)}


def test_twenty_thousand_vectors_of_one_label(spark):
    r = np.random.default_rng(6)
    centres = r.normal(size=(6000, 16)) * 4
    x = np.concatenate([centres, centres + r.normal(size=centres.shape) * 0.05, r.normal(size=(8000, 16)) * 40]).astype("float32")
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(90_000, None, 1), (90_001, [0.0] * 16, None)], "vec_id long, embedding array<float>, label int")
    got = {c.vec_id: c.cluster for c in clustering.embedding_clusters(rows, 0.9).collect()}
    assert sum(got.get(i) == i and got.get(i + 6000) == i for i in range(6000)) > 5900 and all(i < 12_000 for i in got)


@pytest.mark.parametrize("block", [3, 1000])
def test_vectors_against_plain(spark, block):
    r = np.random.default_rng(7)
    x = r.normal(size=(40, 3)).astype("float32")
    rows = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    y = x.astype(float)
    d = np.sqrt(((y[:, None] - y) ** 2).sum(-1))
    pairs = {(p.i, p.j): p.distance for p in clustering.embedding_pairs(rows, 1.0, block).collect()}
    assert pairs == pytest.approx({(i, j): d[i, j] for i in range(40) for j in range(i + 1, 40) if i % 2 == j % 2 and d[i, j] < 1.0})
    want = {}
    for label in (0, 1):
        own = np.arange(label, 40, 2)
        want |= {int(own[i]): int(own[g[0]]) for g in plain_ward(d[np.ix_(own, own)], 1.0) if len(g) > 1 for i in g}
    assert {c.vec_id: c.cluster for c in clustering.embedding_clusters(rows, 1.0).collect()} == want
