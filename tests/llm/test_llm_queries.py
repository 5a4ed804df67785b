"""Registered queries against their SQL, and the pipeline against its stages."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortkit.llm.queries import QUERIES, SQL
from queries.check import rows_of


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    cur = duck.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", ["op5_perspectives", "op8_exact_dedup"])
def test_native_plans(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_pipeline_is_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == first, name
    want = sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.STAGES[-1][1](spark, docs, small).collect())
    got = sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, small).collect())
    assert got == want and got
