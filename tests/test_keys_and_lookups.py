"""Key bitmaps, one shuffle by stay, one lookup for all columns, unique keys."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import cohortkit.operators.sizing as sizing
from cohortkit.operators import cohort as C
from cohortkit.operators import dictionary as D
from cohortkit.operators import evaluate as E
from cohortkit.operators import features as T
from cohortkit.operators import splits as S
from cohortkit.operators.keyfilter import keep_possible, key_bitmap, within_keys
from cohortkit.plans.clean import cohort_features
from cohortkit.session import materialize
from cohortkit.sources.unique import repeated_keys
from queries import views as V
from queries.pipeline_queries import cleaned_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def nothing_is_small(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("n", [1, 500, 20_000])
def test_bitmap_keeps_its_keys_and_few_others(spark, n):
    keys = materialize(spark.range(n).select((F.col("id") * 7).alias("k")))
    rows = spark.range(7 * n + 40_000).select(F.when(F.col("id") % 1001 != 0, F.col("id").cast("int")).alias("k"))
    kept = keep_possible(rows, "k", key_bitmap(keys, "k", n), keys)
    assert kept.join(keys, "k").count() == rows.join(keys, "k").count()
    foreign = rows.join(keys, "k", "left_anti").where("k IS NOT NULL")
    assert kept.join(keys, "k", "left_anti").where("k IS NOT NULL").count() < 0.02 * foreign.count()


def test_bitmap_has_a_bound(spark):
    keys = materialize(spark.range(50_000).withColumnRenamed("id", "k"))
    assert key_bitmap(keys, "k", 50_000, max_bytes=1000) is None
    chunks, n_chunks = key_bitmap(keys, "k", 50_000, max_bytes=60_000)
    assert n_chunks * 512 <= 60_000 + 512 and chunks.where("size(words) <> 64").count() == 0
    rows = spark.range(60_000).withColumnRenamed("id", "k")
    assert keep_possible(rows, "k", (chunks, n_chunks), keys).join(keys, "k").count() == 50_000
    assert keep_possible(rows, "k", None) is rows
    assert keep_possible(rows, "k", key_bitmap(keys.limit(0), "k", 0), keys).count() == 0


def test_semi_join_behind_the_bitmap(spark, small, nothing_is_small):
    keys = materialize(C.matching_keys(V.diagnosis(spark, small), prefixes=("431",), keywords=("none",)))
    for view in (V.vital, V.lab):
        rows = view(spark, small)
        got = within_keys(rows, keys, "patientunitstayid")
        text = plan(got)
        assert text.count("LeftSemi") == 2 and "getbit" in text.lower() or "bit_get" in text
        assert got.exceptAll(rows.join(keys, "patientunitstayid", "left_semi")).count() == 0
        assert got.count() == rows.join(keys, "patientunitstayid", "left_semi").count() > 0


def test_clean_with_a_large_cohort(spark, small, monkeypatch):
    """Foreign rows meet the bitmap before the aggregates."""
    def frame(df):
        return df.toPandas().sort_values("patientunitstayid", ignore_index=True)

    want = frame(cleaned_table(spark, small))
    monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", 0)
    keys = materialize(C.matching_keys(V.diagnosis(spark, small), prefixes=("431",), keywords=("none",)))
    text = plan(cohort_features(keys, V.vital(spark, small), V.lab(spark, small)))
    assert text.count("bit_get") + text.count("getbit") >= 2
    import pandas as pd

    pd.testing.assert_frame_equal(frame(cleaned_table(spark, small)), want, rtol=1e-9)


def test_labs_are_shuffled_once(spark, small):
    """One exchange for the vitals, one for the labs; draws, statistics, map and join use them."""
    keys = materialize(C.matching_keys(V.diagnosis(spark, small), keywords=V.WORDS))
    text = plan(cohort_features(keys, V.vital(spark, small), V.lab(spark, small)))
    assert text.count("Exchange hashpartitioning") == 2
    assert all("hashpartitioning(patientunitstayid" in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


@pytest.mark.parametrize("hot_rows", [1, 40, 10**9])
def test_hot_keys_give_the_same_statistics(spark, monkeypatch, hot_rows):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 0).when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 40).cast("long").alias("patientunitstayid"),
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("n"), F.col("id") % 5)).alias("labname"),
        F.when(F.col("id") % 11 == 0, float("nan")).otherwise((F.col("id") % 100).cast("double")).alias("labresult"),
        (F.col("id") % 7).cast("int").alias("labresultoffset"))
    long = {(r[0], r[1]): (r[2], r[3]) for r in T.aggregate_long(rows).collect()}
    if hot_rows == 1:
        monkeypatch.setattr(T, "HOT_KEYS", 2)
    got = T.statistics_by_key(rows, hot_rows=hot_rows).select("patientunitstayid", F.explode(T.BY_NAME)).collect()
    assert {(r[0], r[1]) for r in got} == set(long)
    for r in got:
        assert r[2]["mean"] == pytest.approx(long[r[0], r[1]][0]) and r[2]["std"] == pytest.approx(long[r[0], r[1]][1])


def levelled(spark, n=600):
    return spark.range(n).select(
        "id", *[F.when(F.col("id") % (7 + i) > 0, F.concat(F.lit("v"), (F.col("id") * (i + 3)) % (90 + i))).alias(f"c{i}") for i in range(4)])


@pytest.mark.parametrize("driver_levels", [0, 10_000])
def test_lookups_of_all_columns(spark, monkeypatch, driver_levels):
    df, columns = levelled(spark), [f"c{i}" for i in range(4)]
    train = df.where("id < 200")
    want = D.encode_labels(df, D.fit_label_dictionary(train, columns), columns, "unk").collect()
    monkeypatch.setattr(D, "DRIVER_LEVELS", driver_levels)
    for most in (0, 100, 10**6):  # none, one and all of the dictionaries are broadcast
        monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", most)
        fitted, sizes = D.fit_labels(train, columns)
        assert sizes == D.dictionary_sizes(fitted)
        got = D.encode_labels(df, fitted, columns, "unk", sizes=sizes)
        assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_wide_rows_are_shuffled_once(spark, nothing_is_small):
    df, columns = levelled(spark).withColumn("wide", F.lit("x")), [f"c{i}" for i in range(4)]
    fitted, sizes = D.fit_labels(df, columns)
    text = plan(D.encode_labels(df, fitted, columns, sizes=sizes))
    wide = [line for line in text.splitlines() if "Exchange" in line]
    assert sum("__row" in line for line in wide) == 2  # the rows, and what was found for them
    assert "Broadcast" not in text


def test_target_means_of_all_columns(spark, monkeypatch):
    df, columns = levelled(spark).withColumn("y", F.col("id") % 2), ["c0", "c1", "c2"]
    def rows():
        encoded = D.encode_target(df, D.fit_target_means(df, columns, "y"), columns)
        return sorted(map(tuple, encoded.select("id", *[F.round(c, 9) for c in columns]).collect()))

    want = rows()
    monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(D, "DRIVER_LEVELS", 0)
    assert rows() == want


def test_a_hundred_thousand_levels(spark):
    """Sparse slots: nothing is collected, and no column is made of a level."""
    df = spark.range(110_000).select("id", F.concat(F.lit("v"), F.col("id") % 100_000).alias("a"), F.when(F.col("id") % 3 > 0, "x").alias("b"))
    slots = D.fit_one_hot_slots(df, ["a", "b"])
    assert slots.count() == 100_002 and slots.agg(F.max("index")).first()[0] == 100_001
    got = D.encode_one_hot_sparse(df, slots, ["a", "b"])
    assert got.columns == ["id", "one_hot_indices", "one_hot_values"]
    assert got.where("size(one_hot_indices) <> 2 OR one_hot_values[1] <> 1.0 OR one_hot_indices[0] >= one_hot_indices[1]").count() == 0
    new = D.encode_one_hot_sparse(spark.createDataFrame([(1, "none", None)], "id LONG, a STRING, b STRING"), slots, ["a", "b"]).first()
    assert new["one_hot_indices"] == [100_001] and new["one_hot_values"] == [1.0]


def test_sparse_statistics_are_the_pivot(spark, small):
    lab = V.lab(spark, small)
    wide = {r["patientunitstayid"]: r.asDict() for r in T.aggregate_and_pivot(lab).collect()}
    names, rows = T.sparse_statistics(T.aggregate_long(lab))
    by_index = {r["index"]: r["labname"] for r in names.collect()}
    assert [by_index[i] for i in range(len(by_index))] == sorted(by_index.values())
    for r in rows.collect():
        held = dict(zip(r["lab_indices"], zip(r["lab_means"], r["lab_stds"])))
        assert list(held) == sorted(held)
        for i, n in by_index.items():
            mean, std = held.get(i, (None, None))
            assert wide[r[0]][f"lab_{n}_mean"] == (mean if mean is None else pytest.approx(mean))
            assert wide[r[0]][f"lab_{n}_std"] == (std if std is None else pytest.approx(std))


def test_repeated_keys_are_named(spark):
    rows = [(str(i), i % 2, f"s{i % 5}") for i in range(50)]
    df = spark.createDataFrame(rows, "patient_id STRING, mortality INT, site_id STRING")
    assert S.split_by_site(df).count() == 50
    again = df.unionAll(df.where("patient_id IN ('7', '9')")).unionAll(df.where("patient_id = '9'"))
    assert sorted(map(tuple, repeated_keys(again, "patient_id").collect())) == [("7", 2), ("9", 3)]
    with pytest.raises(ValueError, match=r"patient_id.*7 \(2 rows\), 9 \(3 rows\)"):
        S.split_by_site(again)
    truth = df.select("patient_id", F.col("mortality").alias("y_true"))
    scores = df.select("patient_id", F.lit(0.4).alias("y_pred_proba"))
    assert E.merge_predictions(truth, scores).count() == 50
    for t, s in ((truth.unionAll(truth.limit(1)), scores), (truth, scores.unionAll(scores))):
        with pytest.raises(PySparkException, match="'patient_id' repeats"):
            E.merge_predictions(t, s).collect()


def test_long_levels_stay_on_the_executors(spark):
    df = spark.range(6).select((F.col("id") % 3).alias("y"), F.concat(F.lit("x" * 600), F.col("id") % 2).alias("long"), F.lit("s").alias("short"))
    assert D._few(D.as_levels(df, ["long", "short"], "-").distinct(), 100) is None
    fitted, sizes = D.fit_labels(df, ["long", "short"])
    assert sizes == {"long": (2, 2 * 633), "short": (1, 33)}
    assert {r["long"] for r in D.encode_labels(df, fitted, ["long", "short"]).collect()} == {0, 1}
    assert D.fit_target_means(df, ["long"], "y").count() == 2
