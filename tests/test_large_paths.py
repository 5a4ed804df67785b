"""The ways used for large tables give the same results as the ways for small ones."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

import cohortkit.operators.dictionary as dictionary
import cohortkit.operators.running as running
import cohortkit.operators.sizing as sizing
from cohortkit.operators import quantiles as Q
from cohortkit.operators import splits as S
from cohortkit.operators.evaluate import roc_points
from cohortkit.operators.transforms import moments
from queries import views as V
from queries.pipeline_queries import cleaned_table

PROBABILITIES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    df = spark.range(60_000).select(
        (F.sin("id") * 1000).alias("smooth"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pow(F.lit(1.0001), F.col("id"))).alias("hot"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 4).cast("double")).alias("few"),
        F.lit(2.5).alias("same"),
        F.when(F.col("id") == 4, F.lit(1.0)).alias("one"),
        F.lit(None).cast("double").alias("none"),
        (F.col("id") * 1_000_003 % 60_000).cast("long").alias("whole"),
    )
    return df.persist()


@pytest.mark.parametrize("bracket_rows", [10, 500, 10_000_000])
def test_quantiles_equal_numpy(values, bracket_rows):
    columns = values.columns
    got = Q.exact_quantiles(values, columns, PROBABILITIES, bracket_rows=bracket_rows)
    table = values.toPandas()
    for c in columns:
        present = table[c].dropna().to_numpy(dtype=float)
        for p in PROBABILITIES:
            if len(present) == 0:
                assert got[c][p] is None
            else:
                assert got[c][p] == pytest.approx(np.quantile(present, p), rel=1e-12), (c, p)


@pytest.mark.parametrize("bracket_rows", [10, 1_000_000])
def test_nan_is_missing_at_any_size(spark, bracket_rows):
    values = [1.0, float("nan"), None, 2.0] * 30
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert Q.exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], bracket_rows=bracket_rows) == {"v": {0.0: 1.0, 0.5: 1.5, 1.0: 2.0}}


@pytest.mark.parametrize("rank", [0, 7, 400, 999])
def test_order_statistic_of_large_whole_numbers(spark, rank):
    values = [1_700_000_000_000_000_000 + i * 7919 % 1000 for i in range(500)] + [-(2**62) + i for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v LONG")
    assert Q.order_statistic(df, "v", rank, 1000) == sorted(values)[rank]


def test_running_totals_over_ranges(spark):
    df = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 11).alias("w")
    )
    for within in ([], ["g"]):
        for down in (False, True):
            small = running.running_totals(df, "k", {"t": "w"}, within, down)
            large = running.running_totals(df, "k", {"t": "w"}, within, down, single_task_rows=10)
            assert small.columns == large.columns or set(small.columns) == set(large.columns)
            columns = sorted(small.columns)
            assert small.select(columns).exceptAll(large.select(columns)).count() == 0
            assert large.count() == 5000


def test_dictionary_over_ranges(spark, monkeypatch):
    train = spark.range(3000).select(
        F.concat(F.lit("v"), F.col("id") % 997).alias("a"), (F.col("id") % 5).cast("string").alias("b")
    )
    small = dictionary.fit_label_dictionary(train, ["a", "b"])
    want = small.collect()
    limited = functools.partial(running.running_totals, single_task_rows=10)
    monkeypatch.setattr(dictionary, "running_totals", limited)
    large = dictionary.fit_label_dictionary(train, ["a", "b"]).collect()
    assert sorted(map(tuple, want)) == sorted(map(tuple, large))
    levels = sorted({f"v{i}" for i in range(997)})
    assert {r["value"]: r["index"] for r in large if r["feature"] == "a"} == {v: i for i, v in enumerate(levels)}


def test_cuts_through_long_prefixes(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 3).cast("int").alias("stratum"),
        S.draw_hash(F.col("id"), 1).alias("hash"),
        F.col("id").cast("string").alias("key"),
        (F.col("id") % 4 + 1).alias("weight"),
    ).persist()
    places = {0: [1, 777, 9_000], 1: [5], 2: [0, 16_000, 10**9]}
    shallow = S.find_cuts(rows, places)
    assert S.find_cuts(rows, places, prefix_rows=1) == shallow
    table = rows.toPandas().sort_values(["hash", "key"])
    for c, ps in places.items():
        part = table[table.stratum == c]
        upto = part.weight.cumsum().to_numpy()
        for p in ps:
            if 0 < p <= upto[-1]:
                at = int(np.searchsorted(upto, p))
                assert shallow[c][p] == (part.hash.iloc[at], part.key.iloc[at])
            else:
                assert p not in shallow[c]


def test_clean_without_broadcast(spark, small):
    want = cleaned_table(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = cleaned_table(spark, small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.columns == want.columns
    def frame(df):
        return df.toPandas().sort_values("patientunitstayid", ignore_index=True)

    import pandas as pd

    pd.testing.assert_frame_equal(frame(got), frame(want), rtol=1e-9)


def test_lookup_without_broadcast(spark, monkeypatch):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("s"))
    fitted = dictionary.fit_label_dictionary(df, ["s"])
    want = dictionary.encode_labels(df, fitted, ["s"])
    monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", 1)
    got = dictionary.encode_labels(df, fitted, ["s"])
    assert got.exceptAll(want).count() == 0 and got.count() == 500


def test_measured_small(spark, monkeypatch):
    df = spark.range(100).select(F.col("id").cast("string").alias("s"))
    assert sizing.measured_small(df) and sizing.measured_small(df.limit(0))
    monkeypatch.setattr(sizing, "BROADCAST_MAX_BYTES", 100)
    assert not sizing.measured_small(df)


def test_one_key_holds_most_rows(spark):
    """A hot stay is merged before the shuffle and gives the same numbers."""
    from cohortkit.operators import features as T

    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).cast("long").alias("patientunitstayid"),
        (F.col("id") * 17 % 4001).cast("int").alias("observationoffset"),
        F.sin("id").alias("v"),
    )
    got = {r[0]: r for r in T.aggregate_wide(df).collect()}
    table = df.toPandas()
    hot = table[table.patientunitstayid == 0].sort_values(["observationoffset", "v"])
    assert got[0]["v_mean"] == pytest.approx(hot.v.mean())
    assert got[0]["v_std"] == pytest.approx(hot.v.std())
    change = (hot.v.iloc[-1] - hot.v.iloc[0]) / (hot.observationoffset.iloc[-1] - hot.observationoffset.iloc[0])
    assert got[0]["v_slope"] == pytest.approx(change)


def test_roc_points_over_ranges(spark, small, monkeypatch):
    import cohortkit.operators.evaluate as evaluate

    scored = V.predictions(spark, small)
    want = roc_points(scored)
    limited = functools.partial(running.running_totals, single_task_rows=3)
    monkeypatch.setattr(evaluate, "running_totals", limited)
    got = evaluate.roc_points(scored)
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_duplicates_by_hash_first(spark, monkeypatch):
    from cohortkit.operators.quality import duplicate_rows

    df = spark.range(3000).select(
        (F.col("id") % 1100).alias("a"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("b"), F.lit(None).cast("int").alias("c")
    )
    want = duplicate_rows(df).first()
    assert want["n_duplicates"] == 3000 - df.distinct().count() > 0
    assert duplicate_rows(df, wide=0).first() == want
    monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", 1)
    assert duplicate_rows(df, wide=0).first() == want
    assert tuple(duplicate_rows(df.limit(0), wide=0).first()) == (0, 0, 0.0)
    assert tuple(duplicate_rows(df.distinct(), wide=0).first()) == (df.distinct().count(), 0, 0.0)


def test_many_levels_are_screened_first(spark):
    from cohortkit.operators.columns import feature_kinds

    df = spark.range(5000).select(
        (F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"), (F.col("id") % 199).alias("some"),
        F.col("id").alias("all"), F.lit(None).cast("double").alias("none"),
    )
    kinds = feature_kinds(df)
    assert kinds == {"numeric": ["eleven", "some", "all"], "categorical": ["ten", "none"]}
    assert feature_kinds(df, max_levels=300)["numeric"] == ["all"]


def test_moments_of_nothing(spark):
    assert moments(spark.range(3), []) == {}
    assert Q.exact_quantiles(spark.range(3), [], [0.5]) == {}
