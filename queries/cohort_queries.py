"""Predicates, projections, joins and column decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.constants import CODE_PREFIXES, LABEL, RANGES_DEFAULT, STAY
from cohortkit.functions.numeric import safe_divide
from cohortkit.functions.text import code_matches, joined_key, text_matches
from cohortkit.operators import cohort as C
from cohortkit.operators import columns as K
from cohortkit.operators import features as T
from cohortkit.session import materialize
from cohortkit.sources.readers import with_identifiers
from queries import views as V
from queries.registry import query, r, rounded

CODE_SQL = "(" + " OR ".join(
    f"starts_with(replace(trim(icd9code), '.', ''), '{p}')" for p in CODE_PREFIXES
) + ")"
WORD_SQL = "(" + " OR ".join(f"contains(lower(diagnosisstring), '{w}')" for w in V.WORDS) + ")"
LABEL_SQL = "CASE WHEN contains(lower(coalesce(hospitaldischargestatus, '')), 'expired') THEN 1 ELSE 0 END"
HITS = f"hits AS (SELECT DISTINCT patientunitstayid FROM diagnosis WHERE {CODE_SQL} OR {WORD_SQL})"
IN_COHORT = "patientunitstayid IN (SELECT patientunitstayid FROM hits)"


def cohort_keys(spark, folder):
    return C.matching_keys(V.diagnosis(spark, folder), keywords=V.WORDS)


@query("b_site_rename_nunique", """
WITH {patient}
SELECT count(*) AS n_rows, count(DISTINCT hospitalid) AS n_sites FROM patient""")
def b_site_rename_nunique(spark, folder):
    return C.rename_site(V.patient(spark, folder)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("site_id").alias("n_sites")
    )


@query("b_icd_prefix_filter", f"""
WITH {{diagnosis}}
SELECT patientunitstayid, icd9code FROM diagnosis WHERE {CODE_SQL}""")
def b_icd_prefix_filter(spark, folder):
    rows = V.diagnosis(spark, folder).where(code_matches(F.col("icd9code")))
    return rows.select(STAY, "icd9code")


@query("b_keyword_filter", f"""
WITH {{diagnosis}}
SELECT patientunitstayid, diagnosisstring FROM diagnosis WHERE {WORD_SQL}""")
def b_keyword_filter(spark, folder):
    rows = V.diagnosis(spark, folder).where(text_matches(F.col("diagnosisstring"), V.WORDS))
    return rows.select(STAY, "diagnosisstring")


@query("b_time_window_vital", """
WITH {vital}
SELECT patientunitstayid, observationoffset, heartrate FROM vital
WHERE observationoffset >= 0 AND observationoffset <= 4320""")
def b_time_window_vital(spark, folder):
    return T.in_window(V.vital(spark, folder), "observationoffset").select(
        STAY, "observationoffset", "heartrate"
    )


@query("b_time_window_lab", """
WITH {lab}
SELECT patientunitstayid, labname, labresult, labresultoffset FROM lab
WHERE labresultoffset >= 0 AND labresultoffset <= 4320""")
def b_time_window_lab(spark, folder):
    return T.in_window(V.lab(spark, folder), "labresultoffset")


@query("b_outlier_null", f"""
WITH {{vital}}
SELECT patientunitstayid, observationoffset,
  CASE WHEN heartrate < 20 OR heartrate > 220 THEN NULL ELSE heartrate END AS heartrate,
  {r("CASE WHEN sao2 < 50 OR sao2 > 100 THEN NULL ELSE sao2 END", "sao2")}, etco2
FROM vital""")
def b_outlier_null(spark, folder):
    return rounded(T.blank_outliers(V.vital(spark, folder), V.RANGES))


@query("b_outlier_counts", """
WITH {vital}
SELECT 'heartrate' AS "column", count(*) FILTER (heartrate < 20 OR heartrate > 220) AS n_outliers FROM vital
UNION ALL
SELECT 'sao2', count(*) FILTER (sao2 < 50 OR sao2 > 100) FROM vital""")
def b_outlier_counts(spark, folder):
    return T.count_outliers(V.vital(spark, folder), V.RANGES)


@query("b_default_limits", """
WITH {vital}
SELECT 'heartrate' AS "column", count(*) FILTER (heartrate < 20 OR heartrate > 220) AS n_outliers FROM vital
UNION ALL SELECT 'respiration', count(*) FILTER (heartrate < 4 * 5 OR heartrate > 60 * 5) FROM vital
UNION ALL SELECT 'systemicmean', count(*) FILTER (heartrate * 2 < 30 OR heartrate * 2 > 200) FROM vital
UNION ALL SELECT 'sao2', count(*) FILTER (sao2 < 50 OR sao2 > 100) FROM vital""")
def b_default_limits(spark, folder):
    """The ranges of the package, on columns that cross them."""
    rate = F.col("heartrate")
    rows = V.vital(spark, folder).withColumns({"respiration": rate / 5, "systemicmean": rate * 2})
    return T.count_outliers(rows, RANGES_DEFAULT)


@query("b_binary_label", f"""
WITH {{patient}}
SELECT patientunitstayid, {LABEL_SQL} AS mortality FROM patient""")
def b_binary_label(spark, folder):
    return C.add_label(V.patient(spark, folder)).select(STAY, LABEL)


@query("b_drop_leakage", f"""
WITH {{patient}}
SELECT * EXCLUDE (hospitaldischargestatus), {LABEL_SQL} AS mortality FROM patient""")
def b_drop_leakage(spark, folder):
    return C.labelled_cohort(V.patient(spark, folder))


@query("b_static_projection", f"""
WITH {{patient}}
SELECT patientunitstayid, age, gender, ethnicity, admissionweight, hospitalid AS site_id,
  {LABEL_SQL} AS mortality
FROM patient""")
def b_static_projection(spark, folder):
    return C.static_columns(C.labelled_cohort(C.rename_site(V.patient(spark, folder))))


@query("b_missing_ratio", "WITH {patient}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_missing, "
    + r(f"CAST(count(*) - count({c}) AS DOUBLE) / count(*)", "missing_ratio") + " FROM patient"
    for c in ("patientunitstayid", "uniquepid", "age", "gender", "ethnicity", "hospitalid",
              "admissionweight", "hospitaldischargestatus", "admission_time")
))
def b_missing_ratio(spark, folder):
    return rounded(K.missing_counts(V.patient(spark, folder)))


@query("b_drop_sparse", f"""
WITH {{patient}}, {{vital}},
measured AS (
  SELECT patientunitstayid, avg(heartrate) AS heartrate_mean, stddev_samp(heartrate) AS heartrate_std,
    avg(sao2) AS sao2_mean, stddev_samp(sao2) AS sao2_std
  FROM vital GROUP BY ALL)
SELECT patientunitstayid, age, gender, ethnicity, admissionweight, {LABEL_SQL} AS mortality,
  {r("heartrate_mean", "heartrate_mean")}, {r("heartrate_std", "heartrate_std")},
  {r("sao2_mean", "sao2_mean")}, {r("sao2_std", "sao2_std")}
FROM patient LEFT JOIN measured USING (patientunitstayid)""")
def b_drop_sparse(spark, folder):
    static = C.static_columns(C.labelled_cohort(V.patient(spark, folder)))
    measured = T.aggregate_wide(V.vital(spark, folder), stats=("mean", "std"))
    wide = materialize(static.join(measured, STAY, "left"))
    return rounded(K.drop_sparse(wide)[0])


@query("b_ids_and_site_fallback", f"""
WITH {{patient}}
SELECT patientunitstayid, CAST(patientunitstayid AS VARCHAR) AS patient_id,
  CAST(patientunitstayid % 10 AS VARCHAR) AS site_id, {LABEL_SQL} AS mortality
FROM patient""")
def b_ids_and_site_fallback(spark, folder):
    return with_identifiers(C.add_label(V.patient(spark, folder)).select(STAY, LABEL))


@query("b_group_key", """
WITH {patient}
SELECT patientunitstayid,
  coalesce(gender, 'nan') || '_' || CAST(hospitalid AS VARCHAR) AS group_key
FROM patient""")
def b_group_key(spark, folder):
    key = joined_key(F.col("gender"), F.col("hospitalid"))
    return V.patient(spark, folder).select(STAY, key.alias("group_key"))


@query("h_safe_divide", f"""
SELECT l_orderkey, l_linenumber, l_shipdate,
  {r("CASE WHEN l_discount = 0 THEN 0 ELSE l_tax / l_discount END", "ratio")}
FROM lineitem""")
def h_safe_divide(spark, folder):
    ratio = safe_divide(F.col("l_tax"), F.col("l_discount"))
    lines = V.table(spark, folder, "lineitem")
    return rounded(lines.select("l_orderkey", "l_linenumber", "l_shipdate", ratio.alias("ratio")))


@query("c_select_cohort", f"""
WITH {{patient}}, {{diagnosis}}, {HITS}
SELECT * FROM patient WHERE {IN_COHORT}""")
def c_select_cohort(spark, folder):
    return C.select_cohort(V.patient(spark, folder), V.diagnosis(spark, folder), keywords=V.WORDS)


@query("c_semi_vital", f"""
WITH {{vital}}, {{diagnosis}}, {HITS}
SELECT patientunitstayid, observationoffset, heartrate, {r("sao2", "sao2")}, etco2
FROM vital WHERE {IN_COHORT}""")
def c_semi_vital(spark, folder):
    return rounded(C.restrict_to(V.vital(spark, folder), cohort_keys(spark, folder)))


@query("c_semi_lab", f"""
WITH {{lab}}, {{diagnosis}}, {HITS}
SELECT * FROM lab WHERE {IN_COHORT}""")
def c_semi_lab(spark, folder):
    return C.restrict_to(V.lab(spark, folder), cohort_keys(spark, folder))
