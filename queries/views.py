"""The four raw tables, and scored rows, as views of the given tables.

Each view exists twice: as a DataFrame and as SQL for the comparison engine.
Gaps are put in by CASE, because the given tables have none; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EPOCH = "1995-01-01"
# The parts' names and the parts' sizes stand in for diagnoses.
WORDS = ("ring", "gear")
RANGES = {"heartrate": (20, 220), "sao2": (50, 100), "absent": (0, 1)}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _days(date):
    return F.datediff(date, F.lit(EPOCH))


def patient(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    years = F.col("o_custkey") % 90
    status = F.when(F.col("o_orderstatus") == "F", "Expired").when(F.col("o_orderstatus") == "O", "Alive")
    return rows.select(
        F.col("o_orderkey").alias("patientunitstayid"),
        F.col("o_custkey").alias("uniquepid"),
        F.when(years >= 85, "> 89").otherwise(years.cast("string")).alias("age"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("gender"),
        F.col("c_mktsegment").alias("ethnicity"),
        F.col("c_nationkey").cast("long").alias("hospitalid"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("c_acctbal")).alias("admissionweight"),
        status.alias("hospitaldischargestatus"),
        F.col("o_orderdate").alias("admission_time"),
    )


def diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    lines, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    code = F.concat(
        F.lit(" "), (F.col("p_partkey") % 20 + 425).cast("string"), F.lit("."), F.col("p_size").cast("string")
    )
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("patientunitstayid"),
        code.alias("icd9code"),
        F.col("p_name").alias("diagnosisstring"),
    )


def vital(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("patientunitstayid"),
        (_days(F.col("l_shipdate")) * 2 - 500).alias("observationoffset"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity") * 5).alias("heartrate"),
        (F.col("l_discount") * 700 + 40).alias("sao2"),
        F.when(F.col("l_partkey") % 20 == 0, F.col("l_tax")).alias("etco2"),
    )


def lab(spark: SparkSession, folder: str) -> DataFrame:
    lines, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    offset = F.floor((_days(F.col("l_shipdate")) * 2 - 500) / 1000.0) * 1000
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("patientunitstayid"),
        F.col("p_type").alias("labname"),
        F.col("l_extendedprice").alias("labresult"),
        offset.cast("int").alias("labresultoffset"),
    )


def lab_events(spark: SparkSession, folder: str) -> DataFrame:
    """Few entities with very many rows each."""
    minutes = _days_from_2024(F.col("ts")) * 1440 + F.hour("ts") * 60 + F.minute("ts")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("patientunitstayid"),
        F.col("event_type").alias("labname"),
        F.col("value").alias("labresult"),
        minutes.alias("labresultoffset"),
    )


def _days_from_2024(date):
    return F.datediff(date, F.lit("2024-01-01"))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    labels, documents = table(spark, folder, "labels"), table(spark, folder, "documents")
    return labels.join(documents, "doc_id").select(
        F.col("doc_id").cast("string").alias("patient_id"),
        F.col("quality").alias("y_true"),
        ((F.col("n_chars") % 1000) / 1000.0).cast("double").alias("y_pred_proba"),
        F.col("lang").alias("protocol"),
    )


# --- The same views as SQL ----------------------------------------------------

_DAYS = f"date_diff('day', DATE '{EPOCH}', CAST(l_shipdate AS DATE))"
VIEW_SQL = {
    "patient": """patient AS (
      SELECT o_orderkey AS patientunitstayid, o_custkey AS uniquepid,
        CASE WHEN o_custkey % 90 >= 85 THEN '> 89' ELSE CAST(o_custkey % 90 AS VARCHAR) END AS age,
        CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS gender,
        c_mktsegment AS ethnicity, CAST(c_nationkey AS BIGINT) AS hospitalid,
        CASE WHEN o_orderkey % 7 <> 0 THEN c_acctbal END AS admissionweight,
        CASE o_orderstatus WHEN 'F' THEN 'Expired' WHEN 'O' THEN 'Alive' END AS hospitaldischargestatus,
        o_orderdate AS admission_time
      FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "diagnosis": """diagnosis AS (
      SELECT l_orderkey AS patientunitstayid,
        ' ' || CAST(425 + p_partkey % 20 AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) AS icd9code,
        p_name AS diagnosisstring
      FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "vital": f"""vital AS (
      SELECT l_orderkey AS patientunitstayid, CAST({_DAYS} * 2 - 500 AS INTEGER) AS observationoffset,
        CASE WHEN l_partkey % 10 <> 0 THEN l_quantity * 5 END AS heartrate,
        l_discount * 700 + 40 AS sao2,
        CASE WHEN l_partkey % 20 = 0 THEN l_tax END AS etco2
      FROM lineitem)""",
    "lab": f"""lab AS (
      SELECT l_orderkey AS patientunitstayid, p_type AS labname, l_extendedprice AS labresult,
        CAST(floor(({_DAYS} * 2 - 500) / CAST(1000 AS DOUBLE)) * 1000 AS INTEGER) AS labresultoffset
      FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "lab_events": """lab_events AS (
      SELECT user_id AS patientunitstayid, event_type AS labname, value AS labresult,
        CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 1440
          + extract(hour FROM ts) * 60 + extract(minute FROM ts) AS INTEGER) AS labresultoffset
      FROM events)""",
    "predictions": """predictions AS (
      SELECT CAST(doc_id AS VARCHAR) AS patient_id, quality AS y_true,
        (n_chars % 1000) / CAST(1000 AS DOUBLE) AS y_pred_proba, lang AS protocol
      FROM labels JOIN documents USING (doc_id))""",
}
