"""Tables whose pages share addresses, against SQL; vectors at the limit; clusters that take many rounds."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom import catalog
from factloom.operators import clustering, relations
from factloom.operators import reviews as rv
from factloom.sources.fixture import TABLES
from tests.test_against_sql import SF, plain


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """The smallest tables, with pages that are 77 apart at one address, and every seventh page at another."""
    where = tmp_path_factory.mktemp("shared")
    con = duckdb.connect()
    for t in TABLES:
        rows = f"SELECT * FROM '{SF}/{t}.parquet'"
        if t == "pages":
            rows = f"SELECT p.* REPLACE (q.url AS url) FROM ({rows}) p JOIN ({rows}) q ON q.page_id = CASE WHEN p.page_id % 7 = 3 THEN 3 ELSE p.page_id % 77 END"
        con.execute(f"COPY ({rows}) TO '{where}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{where}/{t}.parquet'")
    return str(where), con


@pytest.mark.parametrize("name", ["listing_until_known", "merge_precedence", "wide_reviews", "wide_reviews_rest"])
def test_same_rows_where_pages_share_addresses(spark, shared, name):
    where, con = shared
    got = catalog.queries()[name](spark, where)
    cursor = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(str(tuple(map(plain, row))) for row in cursor.fetchall())
    assert want and sorted(str(tuple(plain(r[c]) for c in names)) for r in got.collect()) == want


def test_overlaid(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "url string, n long")
    later = spark.createDataFrame([("a", 7), ("a", 5), ("d", 9), ("c", None)], "url string, n long")
    assert sorted(relations.overlaid(rows, later.where("n IS NOT NULL"), "url", "n").collect()) == [("a", 7), ("a", 7), ("b", 3), ("c", 4), ("d", 9)]


def test_wide_reviews_and_the_rest_hold_every_domain(spark):
    rows = [(i, f"https://site{i}.org/a", "False", 5, 1, 1, "https://bad.example/x") for i in range(5)]
    reviews = spark.createDataFrame(rows, "review_id long, url string, alternate_name string, best int, worst int, value int, appearance string")
    reviews = reviews.withColumns({"claim_reviewed": F.lit("c"), "date_published": F.lit(None).cast("date"), "retrieved_by": F.lit("s")})
    wide = rv.wide_reviews(reviews, most=3).first().asDict()
    assert wide["n_domains"] == 5 and "review_domain_3" not in wide
    rest = {r["place"]: r["review_domain"] for r in rv.reviews_beyond(reviews, 3).collect()}
    assert {i: wide[f"review_domain_{i}"] for i in range(3)} | rest == {i: f"site{i}.org" for i in range(5)}


def test_pairs_at_the_limit_are_decided_as_sql_does(spark):
    """Distances are 1.15 give or take what single precision rounds."""
    r = np.random.default_rng(8)
    base = r.normal(size=(300, 64))
    step = r.normal(size=(300, 64))
    step *= 1.15 / np.linalg.norm(step, axis=1)[:, None]
    x = np.concatenate([base, base + step]).astype("float32")
    table = {"vec_id": range(600), "label": [i % 300 for i in range(600)], "embedding": x.tolist()}
    rows = spark.createDataFrame(list(zip(*table.values())), "vec_id long, label int, embedding array<float>")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, label INT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", list(zip(*table.values())))
    want = set(con.execute(catalog.oracle_sql()["embedding_pairs"]).fetchall())
    got = {(p.i, p.j) for p in clustering.embedding_pairs(rows, 1.15, single=True).collect()}
    assert got == want and 0 < len(want) < 300
    assert {(p.i, p.j) for p in clustering.embedding_pairs(rows, 1.15).collect()} != want  # double precision decides some otherwise


def test_clusters_that_take_more_than_six_rounds(spark):
    """Gaps that grow along a line: each round of mutual neighbours joins one pair. All is joined, however many rounds that takes."""
    at = np.cumsum(1.02 ** np.arange(12) * 0.1)
    rows = spark.createDataFrame([(i, [float(a)], 1) for i, a in enumerate(at)], "vec_id long, embedding array<double>, label int")
    assert {c.cluster for c in clustering.embedding_clusters(rows, 50.0).collect()} == {0}
