"""Every registered query that has SQL gives the same rows as DuckDB."""

import math

import duckdb
import pytest

from strata import plans

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    return str(v)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = plans.QUERIES[name](spark, DIR)
    want = duck.sql(plans.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=repr)
    index = [want.columns.index(c) for c in order]
    theirs = sorted((tuple(plain(r[i]) for i in index) for r in want.fetchall()), key=repr)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_queries_without_sql_run(spark, name):
    assert plans.QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
