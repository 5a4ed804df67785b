"""Files in and out."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit import sources as IO
from cohortkit.operators.fingerprint import table_fingerprint
from cohortkit.session import scratch, shared_folder
from queries import quality_queries, queries


def folders(path):
    return sorted(
        os.path.relpath(os.path.join(root, d), path) for root, ds, _ in os.walk(path) for d in ds
    )


def test_csv_by_header_name_with_missing_spellings(spark, tmp_path):
    path = tmp_path / "lab.csv"
    path.write_text(
        "labname,labresult,patientunitstayid,extra,labresultoffset,note\n"
        "K,NA,1,2.5,10,\"a, b\"\n"
        "NaN,4.5,2,,20.0,null\n"
        "\"He said \"\"x\"\"\",,9007199254740993,7,,N/A\n"
    )
    df = IO.read_table(spark, str(path), IO.SCHEMAS["lab"])
    assert dict(df.dtypes) == {
        "labname": "string", "labresult": "double", "patientunitstayid": "bigint", "extra": "double",
        "labresultoffset": "double", "note": "string",
    }
    rows = {r["patientunitstayid"]: r.asDict() for r in df.collect()}
    assert rows[1]["labresult"] is None and rows[1]["note"] == "a, b" and rows[1]["extra"] == 2.5
    assert rows[2]["labname"] is None and rows[2]["labresultoffset"] == 20 and rows[2]["note"] is None
    assert rows[9007199254740993]["labname"] == 'He said "x"'


def test_raw_tables(spark, tmp_path):
    (tmp_path / "patient.csv").write_text("patientunitstayid,age,hospitalid\n1,> 89,5\n2,40,6\n")
    (tmp_path / "diagnosis.csv").write_text("patientunitstayid,icd9code,diagnosisstring\n1,434.91,x\n2,434,y\n")
    (tmp_path / "vitalPeriodic.csv").write_text("patientunitstayid,observationoffset,heartrate,etco2\n1,5,80,30\n")
    (tmp_path / "lab.csv").write_text("patientunitstayid,labname,labresult,labresultoffset\n1,K,4,5\n")
    raw = IO.read_raw(spark, str(tmp_path))
    assert raw["patient"].schema["age"].dataType.typeName() == "string"
    assert [r["icd9code"] for r in raw["diagnosis"].orderBy("patientunitstayid").collect()] == ["434.91", "434"]
    assert dict(raw["vitalPeriodic"].dtypes)["etco2"] == "double"
    from cohortkit import clean

    with pytest.raises(ValueError, match="status"):
        clean(raw["patient"], raw["diagnosis"], raw["vitalPeriodic"], raw["lab"])
    patient = raw["patient"].withColumn("hospitaldischargestatus", F.lit("Expired"))
    result = clean(patient, raw["diagnosis"], raw["vitalPeriodic"], raw["lab"])
    rows = {r["patientunitstayid"]: r for r in result.cleaned.collect()}
    assert rows[1]["heartrate_mean"] == 80.0 and rows[1]["lab_K_mean"] == 4.0 and rows[2]["mortality"] == 1
    assert "heartrate_std" in result.report.dropped


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "x")], "x DOUBLE, s STRING")
    got = IO.normalize_missing(df)
    assert got.where("x IS NULL AND s IS NULL").count() == 1


def test_cleaned_table(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    IO.write_table(spark.createDataFrame([(12, 1, None), (7, 0, 3.0)], "patientunitstayid LONG, mortality INT, w DOUBLE"), path, "csv")
    rows = {r["patient_id"]: r for r in IO.read_cleaned(spark, path, "csv").collect()}
    assert rows["12"]["site_id"] == "2" and rows["7"]["w"] == 3.0 and rows["12"]["w"] is None
    with_site = spark.createDataFrame([(1, 1, None), (2, 0, 44)], "patientunitstayid LONG, mortality INT, site_id LONG")
    IO.write_table(with_site, path)
    assert sorted(r["site_id"] for r in IO.read_cleaned(spark, path).collect()) == ["44", "nan"]
    IO.write_table(with_site.drop("mortality"), path)
    with pytest.raises(ValueError, match="mortality"):
        IO.read_cleaned(spark, path)


def test_absent_file(spark, tmp_path):
    df, why = IO.read_or_report(spark, str(tmp_path / "none"))
    assert df is None and "PATH" in why
    IO.write_table(spark.range(3), str(tmp_path / "some"))
    df, why = IO.read_or_report(spark, str(tmp_path / "some"))
    assert df.count() == 3 and why is None


def test_packs_and_membership(spark, tmp_path):
    rows = spark.createDataFrame([("1", "train", 5), ("2", "test", 6), ("3", "train", 7)], "patient_id STRING, split STRING, `a.b` INT")
    path = str(tmp_path / "out")
    IO.write_packs(rows, path, "temporal")
    IO.write_packs(rows.where("split = 'train'"), path, "site_holdout")
    # an empty split leaves no folder, and the other protocol is untouched
    assert folders(path) == [
        "protocol=site_holdout", "protocol=site_holdout/split=train",
        "protocol=temporal", "protocol=temporal/split=test", "protocol=temporal/split=train",
    ]
    back = spark.read.parquet(path)
    assert back.where("protocol = 'temporal'").count() == 3 and "a.b" in back.columns
    members = str(tmp_path / "members")
    IO.write_membership(rows, members, "temporal", fmt="csv")
    back = spark.read.option("header", True).csv(members)
    assert sorted(map(tuple, back.select("patient_id", "split").collect())) == [("1", "train"), ("2", "test"), ("3", "train")]


def test_predictions_by_version(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([("1", 0.5)], "patient_id STRING, y_pred_proba DOUBLE")
    IO.write_predictions(rows, path, "temporal", "v1")
    IO.write_predictions(rows, path, "temporal", "v2")
    assert folders(path)[1:] == ["protocol=temporal/version=v1", "protocol=temporal/version=v2"]


def test_catalog_and_manifest(spark, tmp_path):
    df = spark.range(5)
    IO.write_feature_catalog(df, str(tmp_path / "c"), {"numeric": ["id"], "categorical": ["x", "y"]})
    back = spark.read.json(str(tmp_path / "c"))
    assert back.count() == 3 and back.first()["total_features"] == 3 and "generated_at" in back.columns
    for _ in range(2):
        IO.append_manifest(df, str(tmp_path / "m"), {"seed": 42})
    log = spark.read.json(str(tmp_path / "m"))
    assert log.count() == 2 and log.select("data_hash").distinct().count() == 1
    assert log.first()["n_rows"] == 5 and log.first()["config"] == '{"seed": 42}'


def test_fingerprint(spark):
    schema = "a STRING, b STRING"
    base = spark.createDataFrame([("x", None), ("y", "z"), ("y", "z")], schema)
    for portable in (False, True):
        def mark(df):
            return table_fingerprint(df, portable).first()["fingerprint"]

        check_marks(base, mark, spark, schema)


def test_fingerprint_deals_rows_by_size(spark, tmp_path, monkeypatch):
    """One order key and one quantity on all rows: still no task gets a large share of the table."""
    n, key = 80_000, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(n).repartition(8).selectExpr(
        "7L AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "5.0D AS l_quantity")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, plain = [], quality_queries.P.table_fingerprint
    monkeypatch.setattr(quality_queries.P, "table_fingerprint", lambda df: seen.append(df) or plain(df))
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        got = quality_queries.d_table_fingerprint_fast(spark, str(tmp_path)).first()
        whole = F.bit_xor(F.xxhash64(*seen[1].columns))  # reads every column, as the fingerprint does
        shares = [r["n"] for r in seen[1].groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), whole).collect()]
    finally:
        spark.conf.set(key, before)
    # With one key on all rows, none is left without those of the largest key, and the change is seen.
    assert tuple(got) == (n, True, True, True)
    assert "Exchange" in seen[1]._jdf.queryExecution().toString()
    assert sum(shares) == n and max(shares) < n / 4


def check_marks(base, mark, spark, schema):
    assert mark(base) == mark(base.repartition(3).orderBy("a"))
    assert mark(base) != mark(spark.createDataFrame([(None, "x"), ("y", "z"), ("y", "z")], schema))
    assert mark(base) != mark(base.distinct())
    assert mark(base) != mark(base.withColumnRenamed("a", "c"))
    assert mark(base.limit(0)) != mark(base.limit(0).select("a"))


def test_metrics_summary(spark):
    rows = [("p", "test", "before_calibration", "auc", 0.7), ("p", "test", "after_calibration", "auc", 0.8),
            ("p", "val", "before_calibration", "auc", 0.1), ("q", "test", "before_calibration", "f1", 0.5)]
    df = spark.createDataFrame(rows, "protocol STRING, split STRING, stage STRING, metric STRING, value DOUBLE")
    got = {r["protocol"]: r.asDict() for r in IO.metrics_summary(df, ["auc", "f1"]).collect()}
    assert got["p"]["before_calibration_auc"] == 0.7 and got["p"]["after_calibration_auc"] == 0.8
    assert got["q"] == {"protocol": "q", "before_calibration_auc": None, "before_calibration_f1": 0.5,
                        "after_calibration_auc": None, "after_calibration_f1": None}


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_quoted_line_breaks(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    with open(path, "w") as f:
        f.write('patientunitstayid,diagnosisstring\n1,"acute\nstroke"\n2,"said ""no"""\n')
    schema = "patientunitstayid LONG, diagnosisstring STRING"
    rows = IO.read_table(spark, path, schema, "csv", multi_line=True).orderBy("patientunitstayid").collect()
    assert [tuple(r) for r in rows] == [(1, "acute\nstroke"), (2, 'said "no"')]


def test_features_of_given_type(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w") as f:
        f.write("patientunitstayid,mortality,w,note\n1,0,1.5,007\n2,1,,x\n")
    df = IO.read_cleaned(spark, path, "csv", features="w DOUBLE, note STRING")
    assert dict(df.dtypes)["w"] == "double" and sorted(r["note"] for r in df.collect()) == ["007", "x"]


def test_scratch_leaves_nothing(spark, small):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    with scratch(spark):
        assert queries()["flagship_train_ready"](spark, small).count() > 0
        with scratch(spark):
            queries()["flagship_health"](spark, small).collect()
    assert set(os.listdir(folder)) == before
