"""Parts of vectors are clustered from the vectors themselves, and blocks of a label are few."""

import numpy as np
from factloom.operators import clustering


def test_clusters_from_means_are_those_of_the_matrix():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 60, 150):
        for cut in (0.3, 0.9, 2.0):
            x = rng.standard_normal((n, 3)).astype(np.float32)
            sizes = rng.integers(1, 4, n)
            matrix = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(2))
            assert clustering.ward_vectors(x, cut, sizes) == clustering.ward(matrix, cut, sizes)


def vectors(spark, n: int):
    x = np.cumsum(np.full(n, 0.7)) + np.random.default_rng(2).uniform(0, 0.1, n)  # a chain: most pairs of its part are far apart
    return spark.createDataFrame([(i, 0, [float(v), 0.0]) for i, v in enumerate(x)], "vec_id long, label int, embedding array<float>"), x


def test_no_row_for_each_pair_of_a_part(spark):
    rows, x = vectors(spark, 300)
    out = clustering.embedding_clusters(rows, 0.9)
    want = [g for g in clustering.ward(np.abs(x.astype(np.float32)[:, None].astype(float) - x.astype(np.float32)[None].astype(float)), 0.9) if len(g) > 1]
    got = {}
    for r in out.collect():
        got.setdefault(r["cluster"], []).append(r["vec_id"])
    assert sorted(sorted(g) for g in got.values()) == want and len(want) > 50
    assert "id_a < id_b" not in out._jdf.queryExecution().optimizedPlan().toString().replace("#", "")
    assert "Join Inner, ((part" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_vector_moves_a_few_times_only(spark):
    rows, x = vectors(spark, 400)
    few = clustering.embedding_pairs(rows, 0.9, block=10)
    many = clustering.embedding_pairs(rows, 0.9, block=10, most=10)
    near = {(i, j) for i in range(400) for j in range(i + 1, 400) if abs(x[i] - x[j]) < 0.9}
    assert {(r["i"], r["j"]) for r in few.collect()} == {(r["i"], r["j"]) for r in many.collect()} == near
