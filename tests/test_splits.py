"""Splits are whole, disjoint, of the right size, and do not depend on partitioning."""

import datetime

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import splits as S


def people(spark, n=400, per_person=1, sites=7):
    return spark.range(n).select(
        F.col("id").alias("patientunitstayid"),
        F.col("id").cast("string").alias("patient_id"),
        F.floor(F.col("id") / per_person).cast("string").alias("uniquepid"),
        (F.col("id") % sites).cast("string").alias("site_id"),
        (F.col("id") % 5 == 0).cast("int").alias("mortality"),
        F.timestamp_seconds(F.lit(1_600_000_000) + (F.col("id") * 37 % 50) * 86_400).alias("admission_time"),
    )


def test_quotas():
    assert S.held_out({0: 5, 1: 5}, 0.2) == {0: 1, 1: 1}
    assert S.held_out({0: 4, 1: 4}, 0.1 / (0.7 + 0.1)) == {0: 1, 1: 1}
    assert S.held_out({0: 7, 1: 3}, 0.2) == {0: 1, 1: 1}
    assert sum(S.held_out({0: 81, 1: 20, 2: 3}, 0.3).values()) == 32
    with pytest.raises(ValueError):
        S.held_out({0: 5, 1: 1}, 0.2)
    with pytest.raises(ValueError):
        S.held_out({0: 2, 1: 2}, 0.1)


def by_split(rows, *keys):
    out = {}
    for r in rows.groupBy("split", *keys).count().collect():
        out[tuple(r)[:-1] if keys else r["split"]] = r["count"]
    return out


def test_entity_split(spark):
    df = people(spark)
    rows = S.split_by_entity(df)
    assert rows.columns == [*df.columns, "split"]
    assert rows.count() == 400 and rows.select("patient_id").distinct().count() == 400
    # 0.1 / (0.7 + 0.1) is a little above 1/8, so 320 members give 41 for val
    assert by_split(rows, "mortality") == {
        ("test", 0): 64, ("test", 1): 16, ("val", 0): 33, ("val", 1): 8, ("train", 0): 223, ("train", 1): 56,
    }
    with pytest.raises(ValueError):
        S.split_by_entity(df, train_size=0.8)
    with pytest.raises(ValueError):
        S.split_by_entity(df.drop("site_id"))


def test_entity_split_ranks_by_hash(spark):
    """The looked-up cuts pick the same members as ranking everything."""
    df = people(spark, 3000)
    rows = S.split_by_entity(df).collect()
    import hashlib

    for label in (0, 1):
        members = [r for r in rows if r["mortality"] == label]
        order = sorted(
            members, key=lambda r: hashlib.md5(f"{r['patient_id']}_{r['site_id']}|42".encode()).hexdigest()
        )
        got = [r["split"] for r in order]
        assert got == sorted(got, key=["test", "val", "train"].index)


def test_partitioning_and_seed(spark):
    df = people(spark)
    def members(rows):
        return {(r["patient_id"], r["split"]) for r in rows.collect()}

    first = members(S.split_by_entity(df.repartition(1)))
    assert first == members(S.split_by_entity(df.repartition(13, "mortality")))
    assert first != members(S.split_by_entity(df, seed=7))


def test_persons_stay_together(spark):
    df = people(spark, per_person=4)
    rows = S.split_by_entity(df, group_cols=["uniquepid"], order_key="patientunitstayid")
    assert rows.count() == 400
    spread = rows.groupBy("uniquepid").agg(F.count_distinct("split").alias("n"))
    assert spread.where("n > 1").count() == 0
    assert rows.groupBy("split").agg(F.count_distinct("uniquepid")).count() == 3


def test_group_label_is_the_first_present_one(spark):
    rows = [(3, "p", 1), (1, "p", None), (2, "p", 0), (5, "q", None)]
    df = spark.createDataFrame(rows, "k LONG, g STRING, y INT")
    got = {r["group_key"]: (r["label"], r["n_rows"]) for r in S.collapse_groups(df, ["g"], "y", "k").collect()}
    assert got == {"p": (0, 3), "q": (None, 1)}
    with pytest.raises(ValueError, match="label"):
        S.split_by_entity(df, stratify_col="y", group_cols=["g"])


def test_temporal_ten_groups(spark):
    df = people(spark, 10).withColumn("mortality", (F.col("patientunitstayid") % 2).cast("int"))
    result = S.split_by_time(df)
    assert by_split(result.rows) == {"test": 2, "val": 2, "train": 6}


def test_temporal_split(spark):
    df = people(spark)
    result = S.split_by_time(df)
    assert by_split(result.rows) == {"test": 80, "val": 64, "train": 256}
    latest = result.rows.where("split <> 'test'").agg(F.max("admission_time")).first()[0]
    assert latest <= result.cutoff
    assert result.rows.where("split = 'test'").agg(F.min("admission_time")).first()[0] == result.cutoff


def test_temporal_ties_and_missing_times(spark):
    tied = people(spark, 100).withColumn("admission_time", F.lit(datetime.datetime(2020, 1, 1)))
    assert by_split(S.split_by_time(tied).rows) == {"test": 20, "val": 16, "train": 64}
    gaps = people(spark, 100).withColumn(
        "admission_time", F.when(F.col("patientunitstayid") < 70, F.col("admission_time"))
    )
    result = S.split_by_time(gaps)
    assert by_split(result.rows) == {"test": 20, "val": 16, "train": 64}
    assert result.rows.where("split = 'test' AND admission_time IS NOT NULL").count() == 0
    assert result.cutoff is None
    with pytest.raises(ValueError):
        S.split_by_time(gaps.drop("admission_time"))


def test_temporal_without_val(spark):
    result = S.split_by_time(people(spark, 50), val_size=0)
    assert by_split(result.rows) == {"test": 10, "train": 40}


def test_everything_or_nothing_is_test(spark):
    df = people(spark, 50)
    result = S.split_by_time(df, test_size=1.0)
    assert by_split(result.rows) == {"test": 50}
    assert result.cutoff == df.agg(F.min("admission_time")).first()[0]
    result = S.split_by_time(df, test_size=0.0)
    assert by_split(result.rows) == {"val": 10, "train": 40} and result.cutoff is None


def test_time_types(spark):
    df = people(spark, 50)
    for kind in ("date", "timestamp_ntz", "string"):
        rows = S.split_by_time(df.withColumn("admission_time", F.col("admission_time").cast(kind))).rows
        assert by_split(rows) == {"test": 10, "val": 8, "train": 32}


def test_site_cut_in_rows(spark):
    """Sites are taken while those before them hold less than the wanted rows."""
    sizes = {"A": 10, "B": 15, "C": 75}
    rows = [(f"{s}{i}", s, i % 2) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "patient_id STRING, site_id STRING, mortality INT")
    import hashlib

    order = sorted(sizes, key=lambda s: hashlib.md5(f"{s}|42".encode()).hexdigest())
    want, before = set(), 0
    for s in order:
        if before < 20:
            want.add(s)
        before += sizes[s]
    got = {r["site"] for r in S.select_test_sites(df).collect()}
    assert got == want
    split = S.split_by_site(df)
    assert {r["site_id"] for r in split.where("split = 'test'").select("site_id").distinct().collect()} == want


def test_site_split(spark):
    df = people(spark)
    rows = S.split_by_site(df, test_sites=["2", "5"])
    assert rows.where("split = 'test'").select("site_id").distinct().count() == 2
    rest = rows.where("split <> 'test'")
    assert rest.where("site_id IN ('2', '5')").count() == 0
    n = rest.count()
    assert rest.where("split = 'val'").count() == -(-n // 5)
    lost = S.split_by_site(df.withColumn("site_id", F.when(F.col("site_id") != "2", F.col("site_id"))), test_sites=["5"])
    assert lost.where("site_id IS NULL AND split = 'test'").count() == 0 and lost.count() == 400


def test_statistics(spark):
    stats = {r["split"]: r for r in S.split_statistics(S.split_by_entity(people(spark)), site_col="site_id").collect()}
    assert stats["test"]["n_rows"] == 80 and stats["test"]["label_mean"] == pytest.approx(0.2)
    assert stats["train"]["share"] == pytest.approx(279 / 400) and stats["train"]["n_sites"] == 7


def test_missing_row_key_is_named(spark):
    rows = people(spark).withColumn("patient_id", F.when(F.col("patientunitstayid") != 3, F.col("patient_id")))
    with pytest.raises(ValueError, match="1 members have no key"):
        S.split_by_site(rows)
