"""NaN as missing, fractions in whole columns, numeric times and rewritten packs."""

import pytest
from pyspark.errors import PySparkException

from cohortkit.operators import columns as K
from cohortkit.operators import features as T
from cohortkit.operators import quality as Q
from cohortkit.operators import splits as S
from cohortkit.operators import transforms as X
from cohortkit.sources import read_table, write_packs

NAN = float("nan")


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0, 1, 0), (NAN, 1, 1), (None, 1, 2), (2.0, 1, 3)], "v DOUBLE, k LONG, t INT")
    m = X.moments(df, ["v"])["v"]
    assert (m.present, m.mean, m.high) == (2, 1.5, 2.0)
    assert K.missing_counts(df, ["v"]).first()["n_missing"] == 2
    assert K.level_counts(df, ["v"]).first()["n_levels"] == 2
    wide = T.aggregate_wide(df, "k", "t", ["v"]).first()
    assert (wide["v_mean"], wide["v_slope"]) == (1.5, pytest.approx(1 / 3))
    draws = df.selectExpr("k AS patientunitstayid", "'a' AS labname", "v AS labresult", "t AS labresultoffset")
    assert T.aggregate_long(draws).first()["mean"] == 1.5
    near = Q.target_correlations(spark.createDataFrame([(1.0, 0), (NAN, 1), (2.0, 1), (3.0, 1)], "v DOUBLE, y INT"), "y").first()
    assert near["r"] == pytest.approx(0.866025, abs=1e-5)


def test_a_text_target_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "v DOUBLE, y STRING")
    assert Q.target_correlations(df, "y").count() == 0


def test_fractions_are_not_cut(spark, tmp_path):
    (tmp_path / "v.csv").write_text("id,at\n1,-0.5\n2,4320.7\n3,12.0\n")
    rows = read_table(spark, str(tmp_path / "v.csv"), "id LONG, at DOUBLE", "csv")
    assert [r["id"] for r in T.in_window(rows, "at").collect()] == [3]
    assert [r["at"] for r in read_table(spark, str(tmp_path / "v.csv"), "id LONG, at DOUBLE", "csv").collect()] == [-0.5, 4320.7, 12.0]
    with pytest.raises(PySparkException, match="holds a fraction"):
        read_table(spark, str(tmp_path / "v.csv"), "id LONG, at INT", "csv").collect()
    (tmp_path / "w.csv").write_text("id\n1.0\n2\n")
    assert [r["id"] for r in read_table(spark, str(tmp_path / "w.csv"), "id INT", "csv").collect()] == [1, 2]


def test_spellings_of_missing_are_kept_in_parquet(spark, tmp_path):
    spark.createDataFrame([("NA", NAN), ("x", 1.0)], "labname STRING, v DOUBLE").write.parquet(str(tmp_path / "p"))
    got = read_table(spark, str(tmp_path / "p"), fmt="parquet")
    assert sorted(tuple(r) for r in got.collect()) == [("NA", None), ("x", 1.0)]


@pytest.mark.parametrize("kind, of", [("LONG", lambda i: 1_700_000_000_000_000_000 + i), ("DOUBLE", lambda i: i / 100)])
def test_numeric_times_split_by_time(spark, kind, of):
    rows = [(str(i), "s", i % 2, of(i)) for i in range(100)]
    df = spark.createDataFrame(rows, f"patient_id STRING, site_id STRING, mortality INT, admission_time {kind}")
    split = S.split_by_time(df)
    assert sorted(int(r["patient_id"]) for r in split.rows.where("split = 'test'").collect()) == list(range(80, 100))
    assert split.cutoff == of(80)


def test_other_times_are_refused(spark):
    df = spark.createDataFrame([("1", "s", 0, True)], "patient_id STRING, site_id STRING, mortality INT, admission_time BOOLEAN")
    with pytest.raises(TypeError, match="time of type"):
        S.split_by_time(df)


def test_rewritten_packs_replace_all_splits(spark, tmp_path):
    path = str(tmp_path / "packs")
    rows = spark.createDataFrame([(i, ("train", "val", "test")[i % 3]) for i in range(9)], "x INT, split STRING")
    write_packs(rows, path, "p")
    write_packs(rows.where("split <> 'val'"), path, "q")
    write_packs(rows.where("split <> 'val'"), path, "p")
    got = spark.read.parquet(path)
    assert got.where("protocol = 'p'").count() == 6 and got.where("protocol = 'q'").count() == 6
    assert got.where("split = 'val'").count() == 0
