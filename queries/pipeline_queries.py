"""The two whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cohortkit.constants import STAY
from cohortkit.functions.names import col
from cohortkit.operators import quality as Q
from cohortkit.plans import clean, health, run_protocol
from cohortkit.sources.readers import with_identifiers
from queries import views as V
from queries.cohort_queries import HITS, IN_COHORT, LABEL_SQL
from queries.entities import CATEGORIES, draw_sql
from queries.feature_queries import TYPES, VITALS, slope_sql
from queries.registry import query, r, rounded
from queries.transform_queries import index_columns, index_ctes, index_joins

# What is left after the sparse rule on the given tables.
KEPT = (
    "heartrate_mean", "heartrate_std", "heartrate_slope", "sao2_mean", "sao2_std", "sao2_slope",
    *[f"lab_{t}_mean" for t in TYPES],
)
NUMBERS = ("admissionweight", *KEPT)


def _wide() -> str:
    return ", ".join(
        f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std, {slope_sql(c)} AS {c}_slope" for c in VITALS
    )


def _labs() -> str:
    return ", ".join(
        f"{agg}(value) FILTER (labname = '{n}') AS \"lab_{n}_{s}\""
        for n in TYPES for agg, s in (("avg", "mean"), ("stddev_samp", "std"))
    )


CLEANED = f"""{{patient}}, {{diagnosis}}, {{vital}}, {{lab}}, {HITS},
checked AS (
  SELECT patientunitstayid, observationoffset, etco2,
    CASE WHEN heartrate < 20 OR heartrate > 220 THEN NULL ELSE heartrate END AS heartrate,
    CASE WHEN sao2 < 50 OR sao2 > 100 THEN NULL ELSE sao2 END AS sao2
  FROM vital WHERE {IN_COHORT} AND observationoffset BETWEEN 0 AND 4320),
wide AS (SELECT patientunitstayid, {_wide()} FROM checked GROUP BY patientunitstayid),
draws AS (
  SELECT patientunitstayid, labresultoffset, labname, avg(labresult) AS value
  FROM lab WHERE {IN_COHORT} AND labresultoffset BETWEEN 0 AND 4320 GROUP BY ALL),
labs AS (SELECT patientunitstayid, {_labs()} FROM draws GROUP BY patientunitstayid),
cleaned AS (
  SELECT patientunitstayid, age, gender, ethnicity, admissionweight, hospitalid AS site_id,
    {LABEL_SQL} AS mortality, {", ".join(KEPT)}
  FROM patient LEFT JOIN wide USING (patientunitstayid) LEFT JOIN (
    SELECT labs.* FROM labs SEMI JOIN wide USING (patientunitstayid)) USING (patientunitstayid)
  WHERE {IN_COHORT})"""


def cleaned_table(spark, folder):
    return clean(
        *[getattr(V, t)(spark, folder) for t in ("patient", "diagnosis", "vital", "lab")],
        ranges=V.RANGES, keywords=V.WORDS,
    ).cleaned


@query("flagship_clean", f"""
WITH {CLEANED}
SELECT patientunitstayid, age, gender, ethnicity, site_id, mortality, {", ".join(r(c, c) for c in NUMBERS)}
FROM cleaned""")
def flagship_clean(spark, folder):
    return rounded(cleaned_table(spark, folder))


READY = f"""{CLEANED},
grouped AS (
  SELECT * EXCLUDE (site_id), CAST(site_id AS VARCHAR) AS site_id,
    CAST(patientunitstayid AS VARCHAR) AS patient_id,
    CAST(patientunitstayid AS VARCHAR) || '_' || CAST(site_id AS VARCHAR) AS group_key FROM cleaned),
{draw_sql("grouped", "group_key", "mortality")},
train AS (SELECT * FROM drawn WHERE split = 'train'),
{index_ctes(CATEGORIES)},
fills AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUMBERS)} FROM train),
filled AS (SELECT d.* EXCLUDE ({", ".join(NUMBERS)}), {", ".join(f"coalesce(d.{c}, f.{c}) AS {c}" for c in NUMBERS)}
  FROM drawn d, fills f),
fit AS (SELECT {", ".join(f"avg({c}) AS {c}_c, stddev_pop({c}) AS {c}_w" for c in NUMBERS)}
  FROM filled WHERE split = 'train'),
scaled AS (SELECT filled.* EXCLUDE ({", ".join(NUMBERS)}),
    {", ".join(f"({c} - {c}_c) / {c}_w AS {c}" for c in NUMBERS)} FROM filled, fit)"""


@query("flagship_train_ready", f"""
WITH {READY}
SELECT patient_id, split, mortality, {index_columns(CATEGORIES)}, {", ".join(r(c, c) for c in NUMBERS)}
FROM {index_joins(CATEGORIES, "scaled")}""")
def flagship_train_ready(spark, folder):
    cleaned = with_identifiers(cleaned_table(spark, folder))
    return rounded(run_protocol(cleaned, "patient_level").packs)


@query("flagship_health", f"""
WITH {CLEANED}, found AS (
{" UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, mortality) AS r, count(*) - count({c}) AS n_missing FROM cleaned"
                    for c in ("patientunitstayid", "site_id", *NUMBERS))})
SELECT feature AS "column", {r("r", "r")}, n_missing FROM found WHERE r IS NOT NULL""")
def flagship_health(spark, folder):
    """Correlation with the label and gaps of every numeric column of the cleaned table."""
    cleaned = cleaned_table(spark, folder)
    gaps = Q.missing_counts(cleaned).select("column", "n_missing")
    return rounded(Q.target_correlations(cleaned, "mortality").join(gaps, "column"))


CORRELATED = (STAY, "site_id", *NUMBERS)
EVERY_COLUMN = (STAY, "age", "gender", "ethnicity", "site_id", "mortality", *NUMBERS)
N_COLUMNS, N_TEXT = len(EVERY_COLUMN) + 1, 3


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


@query("flagship_health_report", f"""
WITH {CLEANED},
judged AS (SELECT *, coalesce(heartrate_mean, 0) + mortality AS final_rate FROM cleaned),
r AS ({_union(f"SELECT '{c}' AS name, corr({c}, mortality) AS value FROM judged" for c in (*CORRELATED, "final_rate"))}),
gaps AS ({_union(f"SELECT '{c}' AS name, count(*) - count({c}) AS n FROM judged" for c in EVERY_COLUMN)}),
copies AS (SELECT count(*) - count(DISTINCT patientunitstayid) AS n FROM judged),
found AS (
SELECT 'overview' AS report, 'n_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM judged
UNION ALL SELECT 'overview', 'n_columns', {N_COLUMNS}
UNION ALL SELECT 'overview', 'n_numeric', {N_COLUMNS - N_TEXT}
UNION ALL SELECT 'overview', 'n_categorical', {N_TEXT}
UNION ALL SELECT 'id_column', 'patientunitstayid', NULL
UNION ALL SELECT 'structure', CASE WHEN count(*) / CAST(count(DISTINCT patientunitstayid) AS DOUBLE) <= 1.1
  THEN 'STATIC' ELSE 'DYNAMIC' END, count(DISTINCT patientunitstayid) FROM judged
UNION ALL SELECT 'suspicious', 'final_rate', NULL
UNION ALL SELECT 'high', name, value FROM r WHERE abs(value) > 0.9
UNION ALL SELECT 'issues', 'total', 1 + (SELECT count(*) FROM r WHERE abs(value) > 0.9) + (n > 0)::INT FROM copies
UNION ALL (SELECT 'top', name, value FROM r WHERE value IS NOT NULL ORDER BY abs(value) DESC, name LIMIT 5)
UNION ALL SELECT 'duplicates', 'n_duplicates', n FROM copies
UNION ALL SELECT 'target', CAST(mortality AS VARCHAR), count(*) FROM judged GROUP BY mortality
UNION ALL (SELECT 'missing', name, n FROM gaps WHERE n > 0 ORDER BY n DESC, name LIMIT 5)
UNION ALL {_union(f"SELECT 'levels', '{c}', count(DISTINCT {c}) FROM judged" for c in CATEGORIES if c != "site_id")})
SELECT report, name, {r("value", "value")} FROM found""")
def flagship_health_report(spark, folder):
    """The whole quality job over the cleaned table and a column with a telling name."""
    rate = F.coalesce("heartrate_mean", F.lit(0)) + F.col("mortality")
    report = health(cleaned_table(spark, folder).withColumn("final_rate", rate), "mortality")

    def part(name, df, label, value):
        return df.select(F.lit(name).alias("report"), label.cast("string").alias("name"), value.cast("double").alias("value"))

    def listed(name, *rows):
        return spark.createDataFrame([(name, *x) for x in rows], "report STRING, name STRING, value DOUBLE")

    overview = report["overview"].unpivot([], ["n_rows", "n_columns", "n_numeric", "n_categorical"], "name", "value")
    parts = [
        part("overview", overview, col("name"), col("value")),
        listed("id_column", (report["id_column"], None)),
        part("structure", report["structure"], col("data_type"), col("unique_ids")),
        listed("suspicious", *[(c, None) for c, _ in report["suspicious_names"]]),
        part("high", report["high_correlations"], col("column"), col("r")),
        listed("issues", ("total", float(report["n_issues"]))),
        part("top", report["top_correlations"], col("column"), col("r")),
        part("duplicates", report["duplicates"], F.lit("n_duplicates"), col("n_duplicates")),
        part("target", report["target"], col("value"), col("n_rows")),
        part("missing", report["missing"], col("column"), col("n_missing")),
        part("levels", report["cardinality"].where("kind = 'categorical'"), col("column"), col("n_levels")),
    ]
    return rounded(reduce(lambda a, b: a.unionByName(b), parts))
