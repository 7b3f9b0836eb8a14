"""Every query with SQL gives the same rows as that SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from factloom import catalog
from factloom.sources.fixture import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)[:19].removesuffix(" 00:00:00")
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    cols = sorted(got.columns)
    cursor = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    expected = sorted(str(tuple(plain(row[i]) for i in at)) for row in cursor.fetchall())
    assert sorted(str(tuple(plain(r[c]) for c in cols)) for r in got.collect()) == expected
