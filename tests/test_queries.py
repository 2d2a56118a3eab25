"""Every registered query against the SQL that states its result."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import workloads

QUERIES, SQL = workloads.load()
ROWS_ONLY = {
    "isolation_forest", "train_ridge", "train_gbt", "train_gbt_deep", "tree_attribution",
}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in sorted(os.listdir(data)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def lines(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_coverage():
    assert set(SQL) | ROWS_ONLY == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, duck, data):
    df = QUERIES[name](spark, data)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert lines(df.columns, df.collect()) == lines(want.columns, want.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 25
