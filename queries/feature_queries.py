"""Aggregates over time and over attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.constants import STAY
from cohortkit.operators import features as T
from queries import views as V
from queries.registry import query, r, rounded

VITALS = ("heartrate", "sao2", "etco2")
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
EVENTS = ("click", "error", "purchase", "signup", "view")


def slope_sql(c: str, time: str = "observationoffset") -> str:
    """Change between the first and the last present value, ties as documented."""
    there = f"FILTER ({c} IS NOT NULL AND {time} IS NOT NULL)"
    first = f"(min(struct_pack(t := {time}, v := {c})) {there})"
    last = f"(max(struct_pack(t := {time}, v := {c})) {there})"
    return (
        f"({last}.v - {first}.v) / CAST(nullif({last}.t - {first}.t, 0) AS DOUBLE)"
    )


PER_DRAW = """draws AS (
  SELECT patientunitstayid, labresultoffset, labname, avg(labresult) AS value
  FROM {source} WHERE labresult IS NOT NULL GROUP BY ALL)"""


def pivot_sql(names, prefix="lab_") -> str:
    return ",\n".join(
        r(f"{agg}(value) FILTER (labname = '{n}')", f'"{prefix}{n}_{s}"')
        for n in names for agg, s in (("avg", "mean"), ("stddev_samp", "std"))
    )


@query("d_vital_mean_std", "WITH {vital}\nSELECT patientunitstayid, " + ", ".join(
    r(f"{agg}({c})", f"{c}_{s}") for c in VITALS for agg, s in (("avg", "mean"), ("stddev_samp", "std"))
) + " FROM vital GROUP BY ALL")
def d_vital_mean_std(spark, folder):
    return rounded(T.aggregate_wide(V.vital(spark, folder), stats=("mean", "std")))


@query("d_vital_slope", "WITH {vital}\nSELECT patientunitstayid, " + ", ".join(
    r(slope_sql(c), f"{c}_slope") for c in VITALS
) + " FROM vital GROUP BY ALL")
def d_vital_slope(spark, folder):
    return rounded(T.aggregate_wide(V.vital(spark, folder), stats=("slope",)))


@query("d_lab_per_draw", f"""
WITH {{lab}}, {PER_DRAW.replace("{source}", "lab")}
SELECT patientunitstayid, labresultoffset, labname, {r("value", "value")} FROM draws""")
def d_lab_per_draw(spark, folder):
    return rounded(T.mean_per_draw(V.lab(spark, folder)))


@query("d_lab_mean_std_long", f"""
WITH {{lab}}, {PER_DRAW.replace("{source}", "lab")}
SELECT patientunitstayid, labname, {r("avg(value)", "mean")}, {r("stddev_samp(value)", "std")}
FROM draws GROUP BY ALL""")
def d_lab_mean_std_long(spark, folder):
    return rounded(T.aggregate_long(V.lab(spark, folder)))


@query("d_lab_sparse", """
WITH {lab},
draws AS (SELECT patientunitstayid, labresultoffset, labname, avg(labresult) AS value FROM lab GROUP BY ALL),
long AS (SELECT patientunitstayid, labname, avg(value) AS m, stddev_samp(value) AS s FROM draws GROUP BY ALL),
names AS (SELECT labname, row_number() OVER (ORDER BY encode(labname)) - 1 AS i FROM (SELECT DISTINCT labname FROM long))
SELECT patientunitstayid, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS indices,
  """ + r("max(m)", "largest") + ", " + r("arg_min(m, i)", "first_mean") + ", count(s) AS n_std" + """
FROM long JOIN names USING (labname) GROUP BY patientunitstayid""")
def d_lab_sparse(spark, folder):
    """Lists of names and statistics instead of two columns a name."""
    _, rows = T.sparse_statistics(T.aggregate_long(V.lab(spark, folder)))
    return rounded(rows.select(
        STAY, F.array_join(F.col("lab_indices").cast("array<string>"), ",").alias("indices"),
        F.array_max("lab_means").alias("largest"), F.get("lab_means", F.lit(0)).alias("first_mean"),
        F.size(F.array_compact("lab_stds")).cast("long").alias("n_std")))


@query("d_lab_by_key", """
WITH {lab_events}, draws AS (SELECT patientunitstayid, labresultoffset, labname, avg(labresult) AS value FROM lab_events GROUP BY ALL)
SELECT patientunitstayid, labname, """ + r("avg(value)", "mean") + ", " + r("stddev_samp(value)", "std") + """
FROM draws GROUP BY patientunitstayid, labname""")
def d_lab_by_key(spark, folder):
    """One shuffle by key; keys with more than 50 rows count as hot, so nearly all are."""
    maps = T.statistics_by_key(V.lab_events(spark, folder), hot_rows=50)
    return rounded(maps.select(STAY, F.explode(T.BY_NAME).alias("labname", "s")).select(
        STAY, "labname", F.col("s.mean").alias("mean"), F.col("s.std").alias("std")))


@query("d_lab_pivot", f"""
WITH {{lab}}, {PER_DRAW.replace("{source}", "lab")}
SELECT patientunitstayid, {pivot_sql(TYPES)} FROM draws GROUP BY patientunitstayid""")
def d_lab_pivot(spark, folder):
    return rounded(T.aggregate_and_pivot(V.lab(spark, folder)))


@query("d_lab_events_pivot", f"""
WITH {{lab_events}}, {PER_DRAW.replace("{source}", "lab_events")}
SELECT patientunitstayid, {pivot_sql(EVENTS)} FROM draws GROUP BY patientunitstayid""")
def d_lab_events_pivot(spark, folder):
    """Few entities with long histories: every aggregate merges before its shuffle."""
    return rounded(T.aggregate_and_pivot(V.lab_events(spark, folder)))


@query("c_features_left_join", f"""
WITH {{vital}}, {{lab}}, {PER_DRAW.replace("{source}", "lab")},
wide AS (SELECT patientunitstayid, avg(heartrate) AS m, stddev_samp(heartrate) AS s
  FROM vital WHERE observationoffset BETWEEN 0 AND 4320 GROUP BY ALL),
pivoted AS (SELECT patientunitstayid, {pivot_sql(TYPES)} FROM draws GROUP BY patientunitstayid)
SELECT patientunitstayid, {r("m", "heartrate_mean")}, {r("s", "heartrate_std")},
  pivoted.* EXCLUDE (patientunitstayid)
FROM wide LEFT JOIN pivoted USING (patientunitstayid)""")
def c_features_left_join(spark, folder):
    vital = T.in_window(V.vital(spark, folder), "observationoffset")
    wide = T.aggregate_wide(vital, value_cols=["heartrate"], stats=("mean", "std"))
    return rounded(T.join_features(wide, T.aggregate_and_pivot(V.lab(spark, folder))))


@query("c_features_full_join", f"""
WITH {{vital}}, {{lab}}, {PER_DRAW.replace("{source}", "lab")},
wide AS (SELECT patientunitstayid, avg(heartrate) AS m
  FROM vital WHERE observationoffset BETWEEN 0 AND 4320 GROUP BY ALL),
long AS (SELECT patientunitstayid, count(DISTINCT labname) AS n_labs FROM draws GROUP BY ALL)
SELECT patientunitstayid, {r("m", "heartrate_mean")}, n_labs
FROM wide FULL JOIN long USING (patientunitstayid)""")
def c_features_full_join(spark, folder):
    vital = T.in_window(V.vital(spark, folder), "observationoffset")
    wide = T.aggregate_wide(vital, value_cols=["heartrate"], stats=("mean",))
    draws = T.mean_per_draw(V.lab(spark, folder))
    long = draws.groupBy(STAY).agg(F.count_distinct("labname").alias("n_labs"))
    return rounded(T.join_features(wide, long, how="full"))
