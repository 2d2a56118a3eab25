import duckdb
import os
import pytest


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for f in sorted(os.listdir(data)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.fixture(scope="session")
def same_as_sql(spark, duck, data):
    """Checks a registered query against its SQL: names, and rows in any order."""
    from tabularium.llm import queries

    def check(name):
        got, want = queries.QUERIES[name](spark, data), duck.sql(queries.SQL[name])
        names = sorted(got.columns)
        assert names == sorted(want.columns)
        columns = ", ".join(f'"{n}"' for n in names)
        rows = duck.sql(f"SELECT {columns} FROM ({queries.SQL[name]})").fetchall()
        assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, rows))

    return check
