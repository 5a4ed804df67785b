"""One row per stay with a label, categories and numbers: input of splits and transforms."""

from __future__ import annotations

from cohortkit.constants import STAY
from cohortkit.operators import cohort as C
from cohortkit.operators import features as T
from cohortkit.operators.splits import split_by_entity
from cohortkit.session import materialize
from cohortkit.sources.readers import with_identifiers
from queries import views as V
from queries.cohort_queries import LABEL_SQL

CATEGORIES = ("age", "gender", "ethnicity", "site_id")
NUMBERS = ("admissionweight", "heartrate_mean", "sao2_mean")


def people(spark, folder):
    """Stays with label, site and time; no measurements."""
    patient = C.labelled_cohort(C.rename_site(V.patient(spark, folder)))
    return with_identifiers(patient)


def stays(spark, folder):
    static = C.static_columns(people(spark, folder), extra=("patient_id",))
    measured = T.aggregate_wide(
        V.vital(spark, folder), value_cols=["heartrate", "sao2"], stats=("mean",)
    )
    return static.join(measured, STAY, "left")


def assigned(spark, folder):
    """Stays with their split. The stays are written, because every fit reads them again."""
    return split_by_entity(materialize(stays(spark, folder)))


PEOPLE = f"""people AS (
  SELECT patientunitstayid, CAST(patientunitstayid AS VARCHAR) AS patient_id, uniquepid, age, gender,
    ethnicity, CAST(hospitalid AS VARCHAR) AS site_id, admissionweight, {LABEL_SQL} AS mortality, admission_time
  FROM patient)"""
STAYS = """stays AS (
  SELECT p.patientunitstayid, patient_id, age, gender, ethnicity, site_id, admissionweight, mortality,
    heartrate_mean, sao2_mean
  FROM people p LEFT JOIN (
    SELECT patientunitstayid, avg(heartrate) AS heartrate_mean, avg(sao2) AS sao2_mean
    FROM vital GROUP BY ALL) m USING (patientunitstayid))"""


def quota_sql(name: str, counts: str, fraction: str) -> str:
    """CTE (label, c, q): q of the c members of each class are held out."""
    return f"""{name} AS (
  SELECT label, c, CAST(c - kept - CASE WHEN place <= extra THEN 1 ELSE 0 END AS BIGINT) AS q FROM (
    SELECT label, c, kept, n_kept - sum(kept) OVER () AS extra,
      row_number() OVER (ORDER BY share - kept DESC, label) AS place FROM (
      SELECT *, floor(share) AS kept FROM (
        SELECT label, c, n_kept, CAST(c AS DOUBLE) / n * n_kept AS share FROM (
          SELECT label, c, sum(c) OVER () AS n,
            sum(c) OVER () - ceil(CAST(sum(c) OVER () AS DOUBLE) * {fraction}) AS n_kept
          FROM ({counts}))))))"""


def draw_sql(source: str, key: str, label: str, seed: int = 42) -> str:
    """CTEs that add ``split`` to the groups of ``source`` as ``drawn``."""
    return f"""keyed AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5({key} || '|{seed}'), {key}) AS place
  FROM {source}),
{quota_sql("test_quota", f"SELECT {label} AS label, count(*) AS c FROM {source} GROUP BY ALL",
           "CAST(0.2 AS DOUBLE)")},
{quota_sql("val_quota", "SELECT label, c - q AS c FROM test_quota",
           "(CAST(0.1 AS DOUBLE) / (CAST(0.7 AS DOUBLE) + CAST(0.1 AS DOUBLE)))")},
drawn AS (
  SELECT keyed.* EXCLUDE (place), CASE WHEN place <= t.q THEN 'test'
    WHEN place <= t.q + v.q THEN 'val' ELSE 'train' END AS split
  FROM keyed JOIN test_quota t ON t.label = keyed.{label} JOIN val_quota v ON v.label = keyed.{label})"""


ASSIGNED = ",\n".join([
    "{patient}", "{vital}", PEOPLE, STAYS,
    "grouped AS (SELECT *, patient_id || '_' || site_id AS group_key FROM stays)",
    draw_sql("grouped", "group_key", "mortality"),
    "assigned AS (SELECT * EXCLUDE (group_key) FROM drawn)",
    "train AS (SELECT * FROM assigned WHERE split = 'train')",
])
