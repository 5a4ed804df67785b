"""Quality reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortkit.constants import STAY
from cohortkit.operators import columns as K
from cohortkit.operators import fingerprint as P
from cohortkit.operators import quality as Q
from cohortkit.operators.cohort import add_label
from cohortkit.operators.sketches import ScanState
from cohortkit.session import shared_folder
from queries import views as V
from queries.cohort_queries import LABEL_SQL
from queries.entities import PEOPLE, STAYS, stays
from queries.registry import query, r, rounded

STAYS_SQL = f"{{patient}}, {{vital}}, {PEOPLE}, {STAYS}"
LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query("d_target_distribution", f"""
WITH {{patient}}
SELECT {LABEL_SQL} AS value, count(*) AS n_rows, {r("count(*) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE)", "percent")}
FROM patient GROUP BY 1""")
def d_target_distribution(spark, folder):
    return rounded(Q.value_distribution(add_label(V.patient(spark, folder)), "mortality"))


DESCRIBED = ("admissionweight", "heartrate_mean", "sao2_mean", "mortality")


@query("d_describe", f"WITH {STAYS_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, "
    f"{r(f'min({c})', 'min')}, {r(f'quantile_cont({c}, 0.25)', 'q25')}, {r(f'quantile_cont({c}, 0.5)', 'median')}, "
    f"{r(f'quantile_cont({c}, 0.75)', 'q75')}, {r(f'max({c})', 'max')} FROM stays"
    for c in DESCRIBED
))
def d_describe(spark, folder):
    return rounded(Q.describe(stays(spark, folder), DESCRIBED))


@query("d_overall_missing", f"""
WITH {STAYS_SQL}
SELECT count(*) AS n_rows, CAST(10 AS BIGINT) AS n_columns,
  {r("(count(*) * 10 - " + " - ".join(f"count({c})" for c in (
      "patientunitstayid", "patient_id", "age", "gender", "ethnicity", "site_id", "admissionweight",
      "mortality", "heartrate_mean", "sao2_mean")) + ") / CAST(count(*) * 10 AS DOUBLE)", "missing_rate")}
FROM stays""")
def d_overall_missing(spark, folder):
    return rounded(Q.overall_missing(stays(spark, folder)))


def shown(c: str) -> str:
    return f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def fingerprint_sql(table: str, types: dict[str, str]) -> str:
    """CTEs up to ``prints`` (n_rows, hash_xor, hash_sum, fingerprint)."""
    schema = ",".join(f"{c}:{t}" for c, t in types.items())
    text = " || '|' || ".join(shown(c) for c in types)
    return f"""digests AS (SELECT md5({text}) AS d FROM {table}),
hashes AS (SELECT CAST('0x' || substr(d, 1, 15) AS BIGINT) AS a, CAST('0x' || substr(d, 16, 15) AS BIGINT) AS b
  FROM digests),
totals AS (SELECT count(*) AS n_rows, bit_xor(a) AS hash_xor, CAST(sum(a) AS VARCHAR) AS hash_sum,
  CAST(sum(b) AS VARCHAR) AS hash_sum2 FROM hashes),
prints AS (SELECT n_rows, hash_xor, hash_sum, sha256('{schema}|' || n_rows || '|' || hash_xor || '|' ||
  hash_sum || '|' || hash_sum2) AS fingerprint FROM totals)"""


DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query("d_table_fingerprint", f"WITH {fingerprint_sql('documents', DOCUMENT_TYPES)} SELECT * FROM prints")
def d_table_fingerprint(spark, folder):
    """Over whole texts; in the form that any engine can repeat."""
    return P.table_fingerprint(V.table(spark, folder, "documents"), portable=True)


def other_order(rows):
    """All rows, dealt out anew: Spark sets the partitions by their size, so that no task's share grows with the table."""
    return rows.hint("rebalance", "l_orderkey")


@query("d_table_fingerprint_fast", """
SELECT count(*) AS n_rows, true AS same_in_other_order, true AS other_without_a_row, true AS other_with_a_change FROM lineitem""")
def d_table_fingerprint_fast(spark, folder):
    """The row hash is the engine's own, so what is compared is what it can tell apart."""
    rows = V.table(spark, folder, "lineitem")
    last = F.col("l_orderkey") == rows.agg(F.max("l_orderkey")).first()[0]
    changed = F.when(last, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    marks = [P.table_fingerprint(df).first() for df in (
        rows, other_order(rows), rows.where(~last), rows.withColumn("l_quantity", changed))]
    first, *others = [m["fingerprint"] for m in marks]
    return spark.createDataFrame(
        [(marks[0]["n_rows"], first == others[0], first != others[1], first != others[2])],
        "n_rows LONG, same_in_other_order BOOLEAN, other_without_a_row BOOLEAN, other_with_a_change BOOLEAN")


CORRELATED = ("patientunitstayid", "admissionweight", "heartrate_mean", "sao2_mean")
STAY_CORRELATIONS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", corr({c}, mortality) AS r FROM stays" for c in CORRELATED
)


KEPT_STATE = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "gap")


@query("l_cardinality_increment", """
WITH rows_ AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS gap FROM orders),
found AS (
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_present, "
    + (f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high" if c not in ("o_orderstatus", "o_orderpriority")
       else "NULL AS low, NULL AS high") + " FROM rows_" for c in KEPT_STATE) + """)
SELECT "column", n_rows, n_present, low, high, true AS near, 0 AS read_again FROM found""")
def l_cardinality_increment(spark, folder):
    """Two appends; the second scan reads the new files only, and estimates are near a full scan."""
    path = f"{shared_folder(spark)}/cohortkit-{uuid.uuid4().hex}"
    state = ScanState(spark, f"{path}/table", f"{path}/state")
    gap = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("gap")
    rows = V.table(spark, folder, "orders").select(*KEPT_STATE[:-1], gap)
    read_again = 0
    for part in (0, 1):
        before = {r["path"] for r in state.files().collect()} if part else set()
        rows.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == part).write.mode("append").parquet(f"{path}/table")
        added = {r["path"] for r in state.files().collect()} - before
        read_again += state.update() - len(added)
    exact = K.level_counts(rows, rows.columns).withColumnRenamed("n_levels", "exact")
    # Five standard deviations.
    near = F.abs(F.col("n_levels") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.04)
    report = state.report().join(exact, "column")
    return report.select("column", "n_rows", "n_present", "low", "high", near.alias("near"), F.lit(read_again).alias("read_again"))


@query("l_target_correlation", f"""
WITH {STAYS_SQL}
SELECT "column", {r("r", "r")} FROM ({STAY_CORRELATIONS})""")
def l_target_correlation(spark, folder):
    return rounded(Q.target_correlations(stays(spark, folder), "mortality"))


LEAK_NUMBERS = ("l_extendedprice", "l_tax", "heartrate")


@query("l_leak_high_corr", """
WITH rows_ AS (
  SELECT l_quantity, l_extendedprice, l_tax, CASE WHEN l_partkey % 10 <> 0 THEN l_quantity * 5 END AS heartrate
  FROM lineitem),
found AS (
""" + "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", corr({c}, l_quantity) AS r FROM rows_" for c in LEAK_NUMBERS)
+ f""")
SELECT "column", {r("r", "r")} FROM found WHERE abs(r) > 0.9""")
def l_leak_high_corr(spark, folder):
    """A column computed from the target, with gaps of its own."""
    leaked = F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity") * 5).alias("heartrate")
    rows = V.table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_tax", leaked)
    return rounded(Q.high_correlations(rows, "l_quantity"))


LINE_CORRELATIONS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", corr({c}, l_extendedprice) AS r FROM lineitem" for c in LINE_NUMBERS
)


@query("f_top5_correlation", f"""
WITH found AS ({LINE_CORRELATIONS})
SELECT "column", {r("r", "r")} FROM (
  SELECT * FROM found WHERE r IS NOT NULL ORDER BY abs(r) DESC, "column" LIMIT 5)""")
def f_top5_correlation(spark, folder):
    return rounded(Q.top_correlations(V.table(spark, folder, "lineitem"), "l_extendedprice"))


@query("f_top5_missing", """
WITH {patient}, found AS (
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, "
    f"(count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100 AS percent FROM patient"
    for c in ("patientunitstayid", "uniquepid", "age", "gender", "ethnicity", "hospitalid", "admissionweight",
              "hospitaldischargestatus", "admission_time")
) + f""")
SELECT "column", n_missing, {r("percent", "percent")} FROM (
  SELECT * FROM found WHERE n_missing > 0 ORDER BY n_missing DESC, "column" LIMIT 5)""")
def f_top5_missing(spark, folder):
    return rounded(Q.top_missing(V.patient(spark, folder)))


@query("f_largest_entity_sample", """
WITH {lab_events},
top AS (SELECT patientunitstayid FROM lab_events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT patientunitstayid, labresultoffset, labname, labresult
FROM lab_events SEMI JOIN top USING (patientunitstayid)
ORDER BY labresultoffset, labname, labresult LIMIT 5""")
def f_largest_entity_sample(spark, folder):
    return Q.largest_entity_sample(V.lab_events(spark, folder), STAY)


@query("l_largest_entity", """
WITH {diagnosis}
SELECT patientunitstayid, count(*) AS n_rows FROM diagnosis GROUP BY 1
ORDER BY n_rows DESC, patientunitstayid LIMIT 1""")
def l_largest_entity(spark, folder):
    return Q.largest_entity(V.diagnosis(spark, folder), STAY)


@query("l_id_structure", f"""
WITH {{vital}}
SELECT count(*) AS total_rows, count(DISTINCT patientunitstayid) AS unique_ids,
  {r("count(*) / CAST(count(DISTINCT patientunitstayid) AS DOUBLE)", "rows_per_id")},
  CASE WHEN count(*) / CAST(count(DISTINCT patientunitstayid) AS DOUBLE) <= 1.1
    THEN 'STATIC' ELSE 'DYNAMIC' END AS data_type
FROM vital""")
def l_id_structure(spark, folder):
    return rounded(Q.id_structure(V.vital(spark, folder), STAY))


@query("l_duplicate_rows", f"""
WITH {{diagnosis}}, copies AS (SELECT count(*) AS n FROM diagnosis GROUP BY ALL, patientunitstayid, icd9code, diagnosisstring)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
  {r("sum(n - 1) * 100 / CAST(sum(n) AS DOUBLE)", "percent")}
FROM copies""".replace("GROUP BY ALL, ", "GROUP BY "))
def l_duplicate_rows(spark, folder):
    return rounded(Q.duplicate_rows(V.diagnosis(spark, folder)))


@query("l_cardinality_scan", """
SELECT 'text' AS "column", 'categorical' AS kind, count(DISTINCT "text") AS n_levels,
  count(DISTINCT "text") > 100 AS too_many FROM documents
UNION ALL SELECT 'lang', 'categorical', count(DISTINCT lang), count(DISTINCT lang) > 100 FROM documents
UNION ALL SELECT 'source', 'categorical', count(DISTINCT source), count(DISTINCT source) > 100 FROM documents
UNION ALL SELECT 'n_chars', 'numeric', NULL, false""")
def l_cardinality_scan(spark, folder):
    return Q.cardinality(V.table(spark, folder, "documents"), exclude=["doc_id"], limit=100)


KINDS = {
    "age": False, "gender": False, "ethnicity": False, "site_id": False, "admissionweight": True,
    "mortality": True, "heartrate_mean": True, "sao2_mean": True,
}


@query("l_feature_types", f"WITH {STAYS_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_levels, "
    + (f"CASE WHEN count(DISTINCT {c}) <= 10 THEN 'categorical' ELSE 'numeric' END" if number else "'categorical'")
    + " AS kind FROM stays"
    for c, number in KINDS.items()
))
def l_feature_types(spark, folder):
    return K.column_kinds(stays(spark, folder), exclude=[STAY, "patient_id"])
