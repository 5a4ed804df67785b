"""Splits by entity, time and site."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortkit.constants import STAY
from cohortkit.operators import splits as S
from cohortkit.plans import run_protocol
from cohortkit.session import materialize, shared_folder
from queries.entities import ASSIGNED, PEOPLE, assigned, draw_sql, people, quota_sql
from queries.registry import query, r, rounded

PERSONS = f"""{{patient}}, {PEOPLE},
persons AS (
  SELECT CAST(uniquepid AS VARCHAR) AS group_key, arg_min(mortality, patientunitstayid) AS label,
    min(admission_time) AS "time", count(*) AS n_rows
  FROM people GROUP BY ALL)"""

# val: 20% of what is not test, by class, in draw order
REST = quota_sql(
    "val_quota", "SELECT label, count(*) AS c FROM placed WHERE NOT is_test GROUP BY ALL", "CAST(0.2 AS DOUBLE)"
) + """,
drawn AS (
  SELECT placed.*, CASE WHEN is_test THEN 'test' WHEN place <= q THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label, is_test ORDER BY md5(key || '|42'), key) AS place
        FROM placed) placed
  LEFT JOIN val_quota USING (label))"""

SITES = """sites AS (SELECT site_id AS site, count(*) AS n_rows FROM people GROUP BY ALL),
ordered AS (
  SELECT site, n_rows,
    sum(n_rows) OVER (ORDER BY md5(site || '|42'), site ROWS UNBOUNDED PRECEDING) - n_rows AS before
  FROM sites),
chosen AS (
  SELECT site, n_rows FROM ordered
  WHERE before < (SELECT count(*) FROM people) * CAST(0.2 AS DOUBLE))"""


def by_entity(spark, folder):
    return S.split_by_entity(materialize(people(spark, folder)))


def by_site(spark, folder):
    return S.split_by_site(materialize(people(spark, folder)))


@query("d_group_collapse", f"""
WITH {PERSONS}
SELECT * FROM persons""")
def d_group_collapse(spark, folder):
    return S.collapse_groups(people(spark, folder), ["uniquepid"], "mortality", STAY, "admission_time")


@query("f_sites_by_count", f"""
WITH {{patient}}, {PEOPLE}
SELECT site_id AS site, count(*) AS n_rows FROM people GROUP BY ALL""")
def f_sites_by_count(spark, folder):
    return S.site_counts(people(spark, folder))


BY_ENTITY = f"""{{patient}}, {PEOPLE},
grouped AS (SELECT *, patient_id || '_' || site_id AS group_key FROM people),
{draw_sql("grouped", "group_key", "mortality")}"""


@query("g_split_patient", f"""
WITH {BY_ENTITY}
SELECT patient_id, mortality, site_id, split FROM drawn""")
def g_split_patient(spark, folder):
    return by_entity(spark, folder).select("patient_id", "mortality", "site_id", "split")


@query("g_split_person", f"""
WITH {PERSONS}, {draw_sql("persons", "group_key", "label")}
SELECT patient_id, uniquepid, split FROM people JOIN drawn ON group_key = CAST(uniquepid AS VARCHAR)""")
def g_split_person(spark, folder):
    rows = S.split_by_entity(
        materialize(people(spark, folder)), group_cols=["uniquepid"], order_key=STAY
    )
    return rows.select("patient_id", "uniquepid", "split")


TEMPORAL = f"""
WITH {PERSONS},
placed AS (
  SELECT group_key, group_key AS key, label, row_number() OVER (
      ORDER BY "time", md5(group_key || '|42'), group_key)
    > CAST(floor((SELECT count(*) FROM persons) * (1 - CAST(0.2 AS DOUBLE))) AS BIGINT) AS is_test
  FROM persons),
{REST}
SELECT patient_id, uniquepid, split FROM people JOIN drawn ON group_key = CAST(uniquepid AS VARCHAR)"""


@query("g_split_temporal", TEMPORAL)
def g_split_temporal(spark, folder):
    """Times are read from text, as they come from a text file."""
    rows = people(spark, folder).withColumn("admission_time", F.col("admission_time").cast("string"))
    result = S.split_by_time(materialize(rows), group_cols=["uniquepid"], order_key=STAY)
    return result.rows.select("patient_id", "uniquepid", "split")


@query("g_split_temporal_numeric", TEMPORAL)
def g_split_temporal_numeric(spark, folder):
    """The same times as whole nanoseconds, more digits than a DOUBLE holds."""
    nanos = F.unix_micros(F.col("admission_time").cast("timestamp")) * 1000 + 7
    rows = people(spark, folder).withColumn("admission_time", nanos)
    result = S.split_by_time(materialize(rows), group_cols=["uniquepid"], order_key=STAY)
    return result.rows.select("patient_id", "uniquepid", "split")


@query("g_select_test_sites", f"""
WITH {{patient}}, {PEOPLE}, {SITES}
SELECT * FROM chosen""")
def g_select_test_sites(spark, folder):
    return S.select_test_sites(materialize(people(spark, folder).select("site_id")))


BY_SITE = f"""{{patient}}, {PEOPLE}, {SITES},
placed AS (
  SELECT people.*, mortality AS label, patient_id AS key,
    site_id IN (SELECT site FROM chosen) AS is_test FROM people),
{REST}"""


@query("g_split_site", f"""
WITH {BY_SITE}
SELECT patient_id, site_id, mortality, split FROM drawn""")
def g_split_site(spark, folder):
    return by_site(spark, folder).select("patient_id", "site_id", "mortality", "split")


@query("g_split_stats", f"""
WITH {BY_ENTITY}
SELECT split, count(*) AS n_rows, {r("avg(mortality)", "label_mean")},
  {r("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", "share")}
FROM drawn GROUP BY split""")
def g_split_stats(spark, folder):
    return rounded(S.split_statistics(by_entity(spark, folder)))


@query("g_split_site_stats", f"""
WITH {BY_SITE}
SELECT split, count(*) AS n_rows, {r("avg(mortality)", "label_mean")}, count(DISTINCT site_id) AS n_sites,
  {r("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", "share")}
FROM drawn GROUP BY split""")
def g_split_site_stats(spark, folder):
    return rounded(S.split_statistics(by_site(spark, folder), site_col="site_id"))


@query("g_split_membership", f"""
WITH {ASSIGNED}
SELECT patient_id, split FROM assigned""")
def g_split_membership(spark, folder):
    return assigned(spark, folder).select("patient_id", "split")


def _packs(spark, rows, protocol, **options):
    path = f"{shared_folder(spark)}/cohortkit-{uuid.uuid4().hex}"
    run_protocol(materialize(rows), protocol, path=path, **options)
    packs = spark.read.parquet(f"{path}/packs")
    members = spark.read.parquet(f"{path}/splits").withColumnRenamed("split", "member_of")
    joined = packs.join(members, ["protocol", "patient_id"])
    return joined.select("protocol", "patient_id", "mortality", "split", "member_of")


@query("g_packs_site", f"""
WITH {BY_SITE}
SELECT 'site_holdout' AS protocol, patient_id, mortality, split, split AS member_of FROM drawn""")
def g_packs_site(spark, folder):
    """Packs and membership of the site protocol, read back."""
    return _packs(spark, people(spark, folder), "site", exclude=["uniquepid"])


@query("g_packs_temporal", TEMPORAL.replace(
    "SELECT patient_id, uniquepid, split FROM people",
    "SELECT 'temporal' AS protocol, patient_id, mortality, split, split AS member_of FROM people"))
def g_packs_temporal(spark, folder):
    """Packs and membership of the temporal protocol, read back."""
    options = {"group_cols": ["uniquepid"], "order_key": STAY}
    return _packs(spark, people(spark, folder), "temporal", split_options=options)
