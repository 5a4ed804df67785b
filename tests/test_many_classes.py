"""Cuts of very many classes, by tables instead of the driver."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import splits as S
from cohortkit.session import materialize
from queries.entities import draw_sql


@pytest.fixture(scope="module")
def members(spark):
    return materialize(spark.range(110_000).select(
        F.col("id").cast("string").alias("patient_id"), (F.col("id") % 10_000).cast("int").alias("mortality"),
        F.lit("s").alias("site_id")))


def test_ten_thousand_classes_equal_sql(spark, members):
    got = {r["patient_id"]: r["split"] for r in S.split_by_entity(members).collect()}
    rows = members.toPandas()
    con = duckdb.connect()
    con.register("rows_", rows)
    want = dict(con.execute(
        f"WITH grouped AS (SELECT *, patient_id || '_' || site_id AS group_key FROM rows_), {draw_sql('grouped', 'group_key', 'mortality')} "
        "SELECT patient_id, split FROM drawn").fetchall())
    assert got == want and set(want.values()) == {"train", "val", "test"}


@pytest.mark.parametrize("split", ["entity", "site", "time"])
def test_tables_give_the_cuts_of_the_driver(spark, monkeypatch, split):
    rows = materialize(spark.range(3000).select(
        F.col("id").cast("string").alias("patient_id"), (F.col("id") % 7 % 5).cast("int").alias("mortality"),
        F.concat(F.lit("s"), F.col("id") % 13).alias("site_id"), (F.col("id") * 7919 % 1000).alias("admission_time")))

    def run():
        if split == "entity":
            df = S.split_by_entity(rows, group_cols=["patient_id"])
        elif split == "site":
            df = S.split_by_site(rows)
        else:
            df = S.split_by_time(rows, group_cols=["patient_id"]).rows
        return {r["patient_id"]: r["split"] for r in df.select("patient_id", "split").collect()}

    want = run()
    monkeypatch.setattr(S, "PLAN_CLASSES", 2)
    assert run() == want
    monkeypatch.setattr(S, "DRIVER_ROWS", 10)
    assert run() == want


@pytest.mark.parametrize("prefix_rows", [1, 10**6])
def test_cut_table_through_long_prefixes(spark, prefix_rows):
    rows = materialize(spark.range(20_000).select(
        (F.col("id") % 3).cast("int").alias("stratum"), S.draw_hash(F.col("id"), 1).alias("hash"),
        F.col("id").cast("string").alias("key"), (F.col("id") % 4 + 1).alias("weight")))
    wanted = {0: [1, 777, 9_000], 1: [5], 2: [0, 16_000, 10**9]}
    places = spark.createDataFrame([(c, p) for c, ps in wanted.items() for p in ps], "stratum INT, place LONG")
    got = {(r["stratum"], r["place"]): (r["hash"], r["key"]) for r in S.find_cut_table(rows, places, prefix_rows).collect()}
    table = rows.toPandas().sort_values(["hash", "key"])
    want = {}
    for c, ps in wanted.items():
        part = table[table.stratum == c]
        upto = part.weight.cumsum().to_numpy()
        for p in ps:
            if 0 < p <= upto[-1]:
                at = int(np.searchsorted(upto, p))
                want[c, p] = (part.hash.iloc[at], part.key.iloc[at])
    assert got == want


@pytest.mark.parametrize("sizes", [[10, 5], [7, 7, 7, 2], [100, 3, 50, 2, 2], [2] * 40])
def test_quotas_of_a_table(spark, sizes):
    counts = {i: n for i, n in enumerate(sizes)}
    df = spark.createDataFrame(list(counts.items()), "stratum INT, c LONG")
    for fraction in (0.2, 0.5, 1 / 8):
        try:
            want = S.held_out(counts, fraction)
        except ValueError:
            with pytest.raises(ValueError):
                S.held_out_table(df, fraction)
            continue
        assert {r["stratum"]: r["q"] for r in S.held_out_table(df, fraction).collect()} == want


def test_errors_of_many_classes(spark, members, monkeypatch):
    monkeypatch.setattr(S, "PLAN_CLASSES", 0)
    with pytest.raises(ValueError, match="at least 2"):
        S.split_by_entity(members.where("mortality > 9990 OR patient_id = '17'"))
    with pytest.raises(ValueError, match="no label"):
        S.split_by_entity(members.withColumn("mortality", F.expr("nullif(mortality, 3)")))
