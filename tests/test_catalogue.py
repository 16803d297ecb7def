"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pytest

from loomwright.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if isinstance(value, float) and math.isnan(value) else round(float(value), 6)
    return str(value)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_rows_equal_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    want = duck.sql(catalogue.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    there = want.columns
    expected = sorted((tuple(plain(r[there.index(c)]) for c in columns) for r in want.fetchall()), key=repr)
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_others_run(spark, name):
    assert (catalogue.QUERIES[name](spark, SF).count() > 0) == (name != "training_leaks")
