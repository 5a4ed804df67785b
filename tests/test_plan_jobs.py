"""The whole jobs: options, written output, and that fits see training rows only."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit import clean, health, run_protocol, train_ready
from cohortkit.constants import PROTOCOLS
from cohortkit.plans.train_ready import dual_tower
from cohortkit.session import materialize
from cohortkit.sources.readers import with_identifiers
from queries import views as V
from queries.pipeline_queries import cleaned_table

RAW = ("patient", "diagnosis", "vital", "lab")


@pytest.fixture(scope="module")
def raw(spark, small):
    return [getattr(V, t)(spark, small) for t in RAW]


@pytest.fixture(scope="module")
def cleaned(spark, small):
    return materialize(cleaned_table(spark, small))


def test_full_feature_join_keeps_labs_without_vitals(raw):
    patient, diagnosis, vital, lab = raw
    none = vital.where("false")
    left = clean(patient, diagnosis, none, lab, keywords=V.WORDS).cleaned
    full = clean(patient, diagnosis, none, lab, keywords=V.WORDS, feature_join="full").cleaned
    assert not [c for c in left.columns if c.startswith("lab_")]
    assert [c for c in full.columns if c.startswith("lab_")]


def test_no_measurements_at_all(raw):
    patient, diagnosis, vital, lab = raw
    got = clean(patient, diagnosis, vital.where("false"), lab.where("false"), keywords=V.WORDS).cleaned
    assert got.count() > 0 and "mortality" in got.columns


def test_window_and_threshold_are_parameters(raw):
    wide = clean(*raw, keywords=V.WORDS, missing_threshold=1.0)
    assert wide.report.dropped == [] and "etco2_mean" in wide.cleaned.columns
    none = clean(*raw, keywords=V.WORDS, window_hours=0, missing_threshold=0.0)
    assert "heartrate_mean" in none.report.dropped


def test_extra_static_columns_reach_the_time_protocol(raw):
    got = clean(*raw, keywords=V.WORDS, extra_static=("uniquepid", "admission_time")).cleaned
    df = with_identifiers(materialize(got))
    result = run_protocol(df, "temporal", split_options={"group_cols": ["uniquepid"], "order_key": "patientunitstayid"})
    assert result.protocol == "temporal" and result.cutoff is not None
    assert not {"uniquepid", "admission_time", "patientunitstayid"} & set(result.packs.columns)
    spread = result.membership.join(df.select("patient_id", "uniquepid"), "patient_id")
    assert spread.groupBy("uniquepid").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_nan_counts_as_missing(raw):
    patient, diagnosis, vital, lab = raw
    dirty = vital.withColumn("heartrate", F.when(F.col("heartrate").isNull(), float("nan")).otherwise(F.col("heartrate")))
    want = clean(patient, diagnosis, vital, lab, keywords=V.WORDS).cleaned
    got = clean(patient, diagnosis, dirty, lab, keywords=V.WORDS).cleaned
    total = F.round(F.sum("heartrate_mean"), 6)
    assert got.agg(total, F.count("heartrate_std")).first() == want.agg(total, F.count("heartrate_std")).first()


def test_train_ready_writes_all_protocols(spark, cleaned, tmp_path):
    path = str(tmp_path / "ready")
    results = train_ready(cleaned, ("patient_level", "site", "temporal"), path=path)
    # no time column in the cleaned table: that protocol is skipped
    assert sorted(results) == ["patient_level", "site"]
    names = {PROTOCOLS[p] for p in results}
    assert {d.split("=")[1] for d in os.listdir(f"{path}/packs") if "=" in d} == names
    packs = spark.read.parquet(f"{path}/packs")
    for p, r in results.items():
        written = packs.where(F.col("protocol") == PROTOCOLS[p])
        assert written.count() == cleaned.count()
        assert written.groupBy("split").count().count() == 3
        assert r.membership.join(written.select("patient_id", "split"), ["patient_id", "split"]).count() == cleaned.count()
    with pytest.raises(ValueError):
        run_protocol(cleaned, "random")


def test_packs_hold_no_gaps_and_are_standardised(cleaned):
    packs = train_ready(cleaned)["patient_level"].packs
    assert packs.columns[:7] == ["patient_id", "split", "mortality", "age", "gender", "ethnicity", "site_id"]
    assert packs.where(" OR ".join(f"`{c}` IS NULL" for c in packs.columns)).count() == 0
    numbers = packs.columns[7:]
    row = packs.where("split = 'train'").agg(*[F.avg(c) for c in numbers], *[F.stddev_pop(c) for c in numbers]).first()
    for i in range(len(numbers)):
        assert row[i] == pytest.approx(0.0, abs=1e-9) and row[i + len(numbers)] == pytest.approx(1.0)


def test_other_splits_do_not_change_the_fit(spark):
    schema = "patient_id STRING, split STRING, mortality INT, age STRING, w DOUBLE"
    train = [("1", "train", 0, "b", 1.0), ("2", "train", 1, "a", None), ("3", "train", 0, "c", 4.0)]
    def fitted(others):
        out = dual_tower(spark.createDataFrame(train + others, schema))
        return sorted(map(tuple, out.where("split = 'train'").collect()))

    assert fitted([("4", "test", 1, "zz", 1e9)]) == fitted([("4", "val", 0, None, None), ("5", "test", 0, "a", -7.0)])


def test_all_null_training_column(spark):
    schema = "patient_id STRING, split STRING, mortality INT, age STRING, w DOUBLE, gone DOUBLE"
    rows = [("1", "train", 0, "b", 1.0, None), ("2", "train", 1, "a", 2.0, None), ("3", "test", 1, "a", 2.0, 5.0)]
    df = spark.createDataFrame(rows, schema)
    with pytest.raises(ValueError, match="gone"):
        dual_tower(df)
    assert "gone" not in dual_tower(df, on_all_null="drop").columns


def test_health(spark, cleaned, raw):
    report = health(cleaned, "mortality")
    assert report["id_column"] == "patientunitstayid" and report["sample"] is None
    assert report["structure"].first()["data_type"] == "STATIC" and report["n_issues"] == 0
    vital = raw[2].withColumn("copy", F.col("sao2") * 2)
    report = health(vital, "sao2")
    assert report["sample"].count() == 5 and report["n_issues"] == 1
    assert [r["column"] for r in report["high_correlations"].collect()] == ["copy"]
