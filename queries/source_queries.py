"""Reading and writing: what was written is read back."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import functions as F

from cohortkit.constants import STAY
from cohortkit.operators import cohort as C
from cohortkit.operators import columns as K
from cohortkit.operators import evaluate as E
from cohortkit.session import shared_folder
from cohortkit.sources import (
    feature_catalog,
    manifest,
    metrics_summary,
    publish,
    read_cleaned,
    read_or_report,
    read_published,
    read_raw,
    read_table,
    write_membership, write_packs,
    write_predictions,
    write_table,
)
from queries import views as V
from queries.cohort_queries import LABEL_SQL
from queries.entities import ASSIGNED, PEOPLE, STAYS, assigned, stays
from queries.quality_queries import fingerprint_sql
from queries.registry import query, r, rounded


def fresh_path(spark) -> str:
    return f"{shared_folder(spark)}/cohortkit-{uuid.uuid4().hex}"


RAW = ("patient", "diagnosis", "vital", "lab")


@query("a_scan_profile", "WITH {patient}, {diagnosis}, {vital}, {lab}\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT patientunitstayid) AS n_entities FROM {t}"
    for t in RAW
))
def a_scan_profile(spark, folder):
    profiles = [
        getattr(V, t)(spark, folder).agg(
            F.lit(t).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(STAY).alias("n_entities"),
        )
        for t in RAW
    ]
    return reduce(lambda a, b: a.unionByName(b), profiles)


@query("a_csv_read", f"""
WITH {{vital}}
SELECT patientunitstayid, observationoffset, heartrate, {r("sao2", "sao2")}, {r("etco2", "etco2")} FROM vital""")
def a_csv_read(spark, folder):
    """Gaps, whole numbers and decimals survive a text file."""
    path = fresh_path(spark)
    write_table(V.vital(spark, folder), path, "csv")
    schema = "patientunitstayid LONG, observationoffset INT, heartrate DOUBLE, sao2 DOUBLE, etco2 DOUBLE"
    return rounded(read_table(spark, path, schema, "csv"))


RAW_PRESENT = {"patient": "gender", "diagnosis": "icd9code", "vitalPeriodic": "heartrate", "lab": "labresult"}


@query("a_read_raw", "WITH {patient}, {diagnosis}, {vital}, {lab}\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT patientunitstayid) AS n_entities, "
    f"count({c}) AS n_present FROM {'vital' if t == 'vitalPeriodic' else t}"
    for t, c in RAW_PRESENT.items()
))
def a_read_raw(spark, folder):
    """The four tables as a folder of text files."""
    path = fresh_path(spark)
    for name in RAW_PRESENT:
        view = V.vital if name == "vitalPeriodic" else getattr(V, name)
        write_table(view(spark, folder), f"{path}/{name}.csv", "csv")
    profiles = [
        raw.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(STAY).alias("n_entities"), F.count(RAW_PRESENT[name]).alias("n_present"),
        )
        for name, raw in read_raw(spark, path).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), profiles)


@query("a_read_cleaned", f"""
WITH {{patient}}
SELECT patientunitstayid, CAST(patientunitstayid AS VARCHAR) AS patient_id, age, gender, ethnicity,
  CAST(hospitalid AS VARCHAR) AS site_id, {r("admissionweight", "admissionweight")}, {LABEL_SQL} AS mortality
FROM patient""")
def a_read_cleaned(spark, folder):
    """A cleaned table as a text file, its features' types given."""
    path = fresh_path(spark)
    cohort = C.labelled_cohort(C.rename_site(V.patient(spark, folder)))
    write_table(C.static_columns(cohort), path, "csv")
    return rounded(read_cleaned(spark, path, "csv", features="admissionweight DOUBLE"))


@query("a_membership_written", f"""
WITH {ASSIGNED}
SELECT 'patient_stratified' AS protocol, split, patient_id FROM assigned""")
def a_membership_written(spark, folder):
    path = fresh_path(spark)
    write_membership(assigned(spark, folder), path, "patient_stratified")
    return spark.read.parquet(path).select("protocol", "split", "patient_id")


@query("a_packs_rewritten", f"""
WITH {ASSIGNED}
SELECT 'patient_stratified' AS protocol, split, patient_id FROM assigned WHERE split <> 'val'""")
def a_packs_rewritten(spark, folder):
    """Three splits, then two: nothing of the third is left."""
    path = fresh_path(spark)
    rows = assigned(spark, folder).select("patient_id", "split")
    write_packs(rows, path, "patient_stratified")
    write_packs(rows.where("split <> 'val'"), path, "patient_stratified")
    return spark.read.parquet(path).select("protocol", "split", "patient_id")


@query("a_packs_published", f"""
WITH {ASSIGNED}
SELECT 2 AS version, split, patient_id FROM assigned WHERE split <> 'val'
UNION ALL SELECT 1, split, patient_id FROM assigned""")
def a_packs_published(spark, folder):
    """Two committed versions: the latest is what a reader gets, the first can be asked for."""
    path = fresh_path(spark)
    rows = assigned(spark, folder).select("patient_id", "split")
    publish(rows, path, "packs")
    latest = publish(rows.where("split <> 'val'"), path, "packs")
    versions = [(latest, read_published(spark, path, "packs")), (1, read_published(spark, path, "packs", 1))]
    return reduce(lambda a, b: a.unionByName(b), [
        df.select(F.lit(v).alias("version"), "split", "patient_id") for v, df in versions])


@query("a_read_or_report", """
WITH {vital}
SELECT 'written' AS path, count(*) AS n_rows, NULL AS reason FROM vital
UNION ALL SELECT 'absent', NULL, 'PATH_NOT_FOUND'""")
def a_read_or_report(spark, folder):
    """A table that is there, and the reason why another cannot be read."""
    path = fresh_path(spark)
    write_table(V.vital(spark, folder), path)
    rows = []
    for name, at in (("written", path), ("absent", f"{path}-absent")):
        df, reason = read_or_report(spark, at)
        rows.append((name, None if df is None else df.count(), reason))
    return spark.createDataFrame(rows, "path STRING, n_rows LONG, reason STRING")


SCORED = "CASE WHEN y_pred_proba >= 0.5 THEN 1 ELSE 0 END AS y_pred_class"


@query("a_predictions_written", f"""
WITH {{predictions}}
SELECT 'temporal' AS protocol, 'v1' AS version, patient_id, y_true, y_pred_proba, {SCORED} FROM predictions""")
def a_predictions_written(spark, folder):
    path = fresh_path(spark)
    rows = V.predictions(spark, folder)
    scored = E.merge_predictions(rows.select("patient_id", "y_true"), rows.select("patient_id", "y_pred_proba"))
    write_predictions(scored, path, "temporal", "v1")
    return spark.read.parquet(path)


@query("a_feature_catalog", f"""
WITH {{patient}}, {{vital}}, {PEOPLE}, {STAYS}, kinds AS (
SELECT 'age' AS feature, 'categorical' AS kind UNION ALL SELECT 'gender', 'categorical'
UNION ALL SELECT 'ethnicity', 'categorical' UNION ALL SELECT 'site_id', 'categorical'
""" + "".join(
    f"UNION ALL SELECT '{c}', CASE WHEN count(DISTINCT {c}) <= 10 THEN 'categorical' ELSE 'numeric' END FROM stays\n"
    for c in ("admissionweight", "heartrate_mean", "sao2_mean")
) + """)
SELECT feature, kind, CAST(count(*) OVER () AS INTEGER) AS total_features FROM kinds""")
def a_feature_catalog(spark, folder):
    rows = stays(spark, folder)
    return feature_catalog(rows, K.feature_kinds(rows, exclude=[STAY, "patient_id", "mortality"]))


CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"}


@query("a_manifest", f"""
WITH {fingerprint_sql("customer", CUSTOMER_TYPES)}
SELECT n_rows, 4 AS n_columns, '{json.dumps(list(CUSTOMER_TYPES))}' AS columns,
  '{json.dumps(CUSTOMER_TYPES)}' AS dtypes, fingerprint AS data_hash, '{json.dumps({"window_hours": 72})}' AS config
FROM prints""")
def a_manifest(spark, folder):
    rows = V.table(spark, folder, "customer").select(*CUSTOMER_TYPES)
    return manifest(rows, {"window_hours": 72}, portable=True)


METRICS = {
    "accuracy": "avg(CASE WHEN y_true = c THEN 1 ELSE 0 END)",
    "precision": "coalesce(sum(y_true * c) / CAST(nullif(sum(c), 0) AS DOUBLE), 0)",
    "recall": "coalesce(sum(y_true * c) / CAST(nullif(sum(y_true), 0) AS DOUBLE), 0)",
}


@query("a_metrics_summary", """
WITH {predictions},
before AS (SELECT protocol, y_true, CASE WHEN y_pred_proba >= 0.5 THEN 1 ELSE 0 END AS c FROM predictions),
later AS (SELECT protocol, y_true, CASE WHEN y_pred_proba >= 0.3 THEN 1 ELSE 0 END AS c FROM predictions),
b AS (SELECT protocol, """ + ", ".join(r(e, f"before_calibration_{m}") for m, e in METRICS.items()) + """
  FROM before GROUP BY protocol),
l AS (SELECT protocol, """ + ", ".join(r(e, f"after_calibration_{m}") for m, e in METRICS.items()) + """
  FROM later GROUP BY protocol)
SELECT * FROM b JOIN l USING (protocol)""")
def a_metrics_summary(spark, folder):
    """Languages stand in for protocols, two thresholds for the two stages."""
    rows = V.predictions(spark, folder)
    stages = []
    for stage, threshold in (("before_calibration", 0.5), ("after_calibration", 0.3)):
        scored = rows.withColumn("y_pred_class", (F.col("y_pred_proba") >= threshold).cast("int"))
        stages.append(
            E.classification_metrics(scored, ("protocol",))
            .withColumns({"split": F.lit("test"), "stage": F.lit(stage)})
        )
    return rounded(metrics_summary(stages[0].unionByName(stages[1]), list(METRICS)))
