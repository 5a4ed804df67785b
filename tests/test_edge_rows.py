"""Rows at the edges of each rule."""

import pytest
from pyspark.sql import functions as F

from cohortkit.constants import RANGES_DEFAULT
from cohortkit.functions.numeric import safe_divide
from cohortkit.functions.text import code_matches, died, joined_key, text_matches
from cohortkit.operators import cohort as C
from cohortkit.operators import columns as K
from cohortkit.operators import features as T
from cohortkit.operators import quality as Q

approx = pytest.approx


def column_of(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_code_prefix(spark):
    codes = [" 434.91 ", "\t431", " 433.1", "I63, 434", "4", "", "4.3.6", "0430", None]
    df = spark.createDataFrame([(c,) for c in codes], "code STRING").coalesce(1)
    got = column_of(df, code_matches(F.col("code")))
    assert got == [True, True, True, False, False, False, True, False, False]


def test_code_list_is_searched_only_on_request(spark):
    df = spark.createDataFrame([("I63, 434.1",), (None,), ("1,2",)], "code STRING").coalesce(1)
    assert column_of(df, code_matches(F.col("code"))) == [False, False, False]
    assert column_of(df, code_matches(F.col("code"), split_codes=True)) == [True, False, False]


def test_keywords(spark):
    texts = ["Acute STROKE", "which", "sepsis", "ICH, left", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").coalesce(1)
    assert column_of(df, text_matches(F.col("t"))) == [True, True, False, True, False, False]
    whole = column_of(df, text_matches(F.col("t"), whole_word=True))
    assert whole == [True, False, False, True, False, False]


def test_cohort_needs_one_of_two_columns(spark):
    patient = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "patientunitstayid LONG, v STRING")
    codes = spark.createDataFrame([(1, "434"), (2, "999"), (1, "431"), (None, "430")], "patientunitstayid LONG, icd9code STRING")
    assert [r[0] for r in C.select_cohort(patient, codes).collect()] == [1]
    words = codes.select("patientunitstayid", F.lit("old stroke").alias("diagnosisstring"))
    assert sorted(r[0] for r in C.select_cohort(patient, words).collect()) == [1, 2]
    with pytest.raises(KeyError):
        C.select_cohort(patient, codes.drop("icd9code"))


def test_window_ends_count(spark):
    df = spark.createDataFrame([(-1,), (0,), (4320,), (4321,), (None,)], "o INT")
    assert sorted(column_of(T.in_window(df, "o"), "o")) == [0, 4320]
    assert column_of(T.in_window(df, "o", 0), "o") == [0]


def test_outliers(spark):
    rows = [(19.9,), (20.0,), (220.0,), (220.1,), (None,)]
    df = spark.createDataFrame(rows, "heartrate DOUBLE").coalesce(1)
    assert column_of(T.blank_outliers(df, RANGES_DEFAULT), "heartrate") == [None, 20.0, 220.0, None, None]
    assert [tuple(r) for r in T.count_outliers(df, RANGES_DEFAULT).collect()] == [("heartrate", 2)]
    limits = {"heartrate": (20, 220), "other": (0, 1), "broken": 5}
    good, skipped = T.usable_ranges(df, limits)
    assert list(good) == ["heartrate"] and skipped == ["other", "broken"]
    assert T.count_outliers(df, {"other": (0, 1)}).count() == 0


def test_label(spark):
    states = [("Expired",), ("EXPIRED - x",), ("Alive",), (None,)]
    df = spark.createDataFrame(states, "hospitaldischargestatus STRING").coalesce(1)
    assert column_of(df, died(F.col("hospitaldischargestatus"))) == [1, 1, 0, 0]
    assert C.add_label(df, null_label="drop").count() == 3
    assert C.labelled_cohort(df).columns == ["mortality"]
    with pytest.raises(ValueError):
        C.add_label(df.withColumnRenamed("hospitaldischargestatus", "x"))
    with pytest.raises(ValueError):
        C.add_label(df, null_label="guess")


def test_site_is_required(spark):
    with pytest.raises(ValueError):
        C.rename_site(spark.range(1))


def test_missing_part_of_a_key_stays_visible(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x STRING, y STRING").coalesce(1)
    assert column_of(df, joined_key(F.col("x"), F.col("y"))) == ["a_nan", "nan_b"]


def vitals(spark, rows):
    return spark.createDataFrame(rows, "patientunitstayid LONG, observationoffset INT, v DOUBLE")


def test_mean_std_slope(spark):
    rows = [
        (1, 0, 4.0),
        (2, 0, 2.0), (2, 1, 4.0), (2, 2, None),
        (3, 0, 10.0), (3, 30, None), (3, 60, 40.0),
        (4, 5, 1.0), (4, 5, 9.0),
        (5, 0, None),
        (6, 0, 3.0), (6, 0, 1.0), (6, 10, 2.0), (6, 10, 6.0),
        (7, None, 3.0), (7, 1, 5.0),
        (None, 0, 1.0),
    ]
    got = {r[0]: tuple(r)[1:] for r in T.aggregate_wide(vitals(spark, rows)).collect()}
    assert got[1] == (4.0, None, None)
    assert got[2] == (3.0, approx(1.4142136), 2.0)
    assert got[3] == (25.0, approx(21.2132034), 0.5)
    assert got[4] == (5.0, approx(5.6568542), None)
    assert got[5] == (None, None, None)
    assert got[6][2] == approx((6 - 1) / 10)
    assert got[7] == (4.0, approx(1.4142136), None)
    assert None not in got


def test_measurement_columns_are_the_numeric_ones(spark):
    df = spark.createDataFrame([(1, 0, 1.0, "x", 7)], "patientunitstayid LONG, observationoffset INT, v DOUBLE, s STRING, rowid LONG")
    assert T.aggregate_wide(df, stats=("mean",)).columns == ["patientunitstayid", "v_mean", "rowid_mean"]
    assert T.aggregate_wide(df, stats=("mean",), exclude=["rowid"]).columns == ["patientunitstayid", "v_mean"]
    assert T.aggregate_wide(df, value_cols=[]).columns == ["patientunitstayid"]


def test_labs_are_averaged_per_draw_first(spark):
    rows = [
        (1, "K", 1.0, 0), (1, "K", 3.0, 0), (1, "K", 6.0, 5), (1, "Na/x, y.z", 7.0, 0),
        (2, None, 1.0, 0), (2, "gone", None, 0), (None, "K", 1.0, 0), (3, "K", 2.0, None),
    ]
    lab = spark.createDataFrame(rows, "patientunitstayid LONG, labname STRING, labresult DOUBLE, labresultoffset INT")
    wide = T.aggregate_and_pivot(lab)
    assert wide.columns == [
        "patientunitstayid", "lab_K_mean", "lab_K_std", "lab_Na/x, y.z_mean", "lab_Na/x, y.z_std",
    ]
    assert [tuple(r) for r in wide.collect()] == [(1, 4.0, approx(2.8284271), 7.0, None)]


def test_any_number_of_names(spark):
    long = spark.range(12_000).select(F.col("id").cast("string").alias("labname"))
    assert len(T.attribute_names(long)) == 12_000
    draws = long.select(F.lit(1).alias("patientunitstayid"), "labname", F.lit(2.0).alias("labresult"), F.lit(0).alias("labresultoffset"))
    assert T.aggregate_long(draws).count() == 12_000


def test_names_that_differ_in_case(spark):
    rows = [(1, "PT", 1.0, 0), (1, "pt", 2.0, 0)]
    lab = spark.createDataFrame(rows, "patientunitstayid LONG, labname STRING, labresult DOUBLE, labresultoffset INT")
    with pytest.raises(ValueError, match="case"):
        T.aggregate_and_pivot(lab)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        row = T.aggregate_and_pivot(lab).first().asDict()
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert row["lab_PT_mean"] == 1.0 and row["lab_pt_mean"] == 2.0


def test_feature_join(spark):
    wide = spark.createDataFrame([(1, 1.0)], "patientunitstayid LONG, a DOUBLE")
    labs = spark.createDataFrame([(1, 2.0), (2, 3.0)], "patientunitstayid LONG, b DOUBLE")
    assert T.join_features(wide, labs).count() == 1
    assert T.join_features(wide, labs, how="full").count() == 2
    with pytest.raises(ValueError):
        T.join_features(wide, labs, how="cross")


def test_sparse_rule_is_strict(spark):
    rows = [(i, 1.0 if i < 3 else None, 1.0 if i < 2 else None, None) for i in range(10)]
    df = spark.createDataFrame(rows, "id LONG, seven DOUBLE, eight DOUBLE, `all.gone` DOUBLE")
    kept, report = K.drop_sparse(df, 0.7)
    assert kept.columns == ["id", "seven"]
    assert report.dropped == ["eight", "all.gone"] and report.kept_with_missing == ["seven"]
    assert K.drop_sparse(df.limit(0))[0].columns == df.columns


def test_cleaned_table_is_checked(spark):
    with pytest.raises(RuntimeError):
        K.check_cleaned(spark.sql("SELECT 1 AS mortality, 'x' AS unitdischargestatus"))
    with pytest.raises(RuntimeError):
        K.check_cleaned(spark.sql("SELECT 1 AS other"))


def test_feature_kinds_and_roles(spark):
    df = spark.range(30).select(
        "id", (F.col("id") % 3).alias("few"), F.col("id").cast("double").alias("many"),
        F.lit("t").alias("text"), (F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"),
    )
    kinds = K.feature_kinds(df, exclude=["id"])
    assert kinds == {"numeric": ["many", "eleven"], "categorical": ["few", "text", "ten"]}
    roles = spark.sql("SELECT 1 patient_id, 1 mortality, 'x' age, 'y' site_id, 2.0 w, 3.0 admission_time")
    assert K.feature_roles(roles) == (["age", "site_id"], ["w"])


def test_zero_signs_are_one_level(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "x DOUBLE")
    assert K.level_counts(df, ["x"]).collect()[0]["n_levels"] == 2


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (1.0, None)], "a DOUBLE, b DOUBLE").coalesce(1)
    assert column_of(df, safe_divide(F.col("a"), F.col("b"))) == [0.0, 0.5, None]


def test_correlation_skips_constant_columns(spark):
    rows = [(1.0, 1, 5.0, 2.0), (2.0, 0, 5.0, None), (3.0, 1, 5.0, 4.0), (4.0, None, 5.0, 9.0)]
    df = spark.createDataFrame(rows, "x DOUBLE, y INT, same DOUBLE, pair DOUBLE")
    got = {r["column"]: r["r"] for r in Q.target_correlations(df, "y").collect()}
    # pair: two rows are left and the label is constant there
    assert set(got) == {"x"} and got["x"] == approx(0.0)
    assert Q.target_correlations(df, "absent").count() == 0


def test_duplicates(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("x", None), ("y", 1)], "a STRING, b INT")
    assert tuple(Q.duplicate_rows(df).first()) == (4, 2, 50.0)
    assert tuple(Q.duplicate_rows(df.limit(0)).first()) == (0, 0, 0.0)


def test_id_structure(spark):
    df = spark.createDataFrame([(i // 1,) for i in range(10)] + [(0,)], "id LONG")
    assert Q.id_structure(df, "id").first()["data_type"] == "STATIC"
    assert Q.id_structure(df.union(df), "id").first()["data_type"] == "DYNAMIC"
    empty = Q.id_structure(df.limit(0), "id").first()
    assert empty["rows_per_id"] is None


def test_names_by_schema(spark):
    df = spark.sql("SELECT 1 AS Guid, 2 AS x")
    assert Q.find_id_column(df) == "Guid"
    assert Q.find_id_column(spark.sql("SELECT 2 AS x")) == "x"
    assert Q.find_id_column(spark.sql("SELECT 2 AS stay_id, 1 AS patientunitstayid")) == "patientunitstayid"
    named = spark.sql("SELECT 1 AS mortality, 1 AS ICDcode, 1 AS heartrate, 1 AS deathdate")
    assert Q.suspicious_names(named, "mortality") == [("ICDcode", "icd"), ("deathdate", "death")]
    assert Q.time_columns(named) == ["deathdate"]


def test_largest_entity_sample(spark):
    rows = [(1, 5, "a"), (2, 9, "b"), (2, 1, "c"), (2, 3, "d"), (None, 0, "z"), (None, 0, "z"), (None, 0, "z"), (None, 0, "z")]
    df = spark.createDataFrame(rows, "id LONG, offset INT, s STRING")
    got = [tuple(r) for r in Q.largest_entity_sample(df, "id", 2).collect()]
    assert got == [(2, 1, "c"), (2, 3, "d")]
    assert Q.largest_entity_sample(df.limit(0), "id").count() == 0


def test_top_missing_and_distribution(spark):
    df = spark.createDataFrame([(1, None, None), (1, 2, None), (None, 2, None), (0, 2, 1)], "a INT, b INT, c INT")
    got = [tuple(r) for r in Q.top_missing(df, 2).collect()]
    assert got == [("c", 3, 75.0), ("a", 1, 25.0)]
    spread = {r["value"]: (r["n_rows"], r["percent"]) for r in Q.value_distribution(df, "a").collect()}
    assert spread == {1: (2, 50.0), 0: (1, 25.0)}
    assert Q.overall_missing(df).first()["missing_rate"] == approx(5 / 12)


def test_describe(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (9.0, None)], "x DOUBLE, n DOUBLE")
    got = {r["column"]: tuple(r)[1:] for r in Q.describe(df).collect()}
    assert got["x"] == (4, 4.0, approx(3.5590261), 1.0, 1.75, 3.0, 5.25, 9.0)
    assert got["n"] == (0, None, None, None, None, None, None, None)


def test_cardinality(spark):
    df = spark.range(30).select("id", F.concat(F.lit("v"), F.col("id")).alias("wide"), F.lit("x").alias("one"))
    got = {r["column"]: (r["kind"], r["n_levels"], r["too_many"]) for r in Q.cardinality(df, limit=10).collect()}
    assert got == {
        "id": ("numeric", None, False), "wide": ("categorical", 30, True), "one": ("categorical", 1, False),
    }
    near = {r["column"]: r["n_levels"] for r in Q.cardinality(df, limit=10, deviation=0.01).collect()}
    assert near["wide"] == approx(30, abs=1) and near["one"] == 1
