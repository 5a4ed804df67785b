"""Every registered query against its SQL on the given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from queries import oracle_sql, queries
from queries.check import rows_of

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(medium):
    con = duckdb.connect()
    for f in Path(medium).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, medium, duck, name):
    df = QUERIES[name](spark, medium)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got
    cur = duck.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall())


def test_entry_has_them_all():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.schema == entry.entry(spark).schema
