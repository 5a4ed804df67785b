"""Transforms fitted on training rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cohortkit.operators import dictionary as D
from cohortkit.operators import evaluate as E
from cohortkit.operators import neighbours as N
from cohortkit.operators import quality as Q
from cohortkit.operators import transforms as X
from queries import views as V
from queries.entities import ASSIGNED, CATEGORIES, NUMBERS, assigned
from queries.evaluate_queries import GRID, ROC
from queries.registry import query, r, rounded

IDS = ["patient_id", "split"]


def train_of(rows):
    return rows.where(F.col("split") == "train")


def index_ctes(columns, missing: str = "Unknown") -> str:
    """A CTE per column with the index of each training level."""
    return ",\n".join(
        f"dict_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY encode(v)) - 1 AS INTEGER) AS i "
        f"FROM (SELECT DISTINCT coalesce({c}, '{missing}') AS v FROM train))"
        for c in columns
    )


def index_joins(columns, source: str, missing: str = "Unknown") -> str:
    return source + "".join(
        f"\nLEFT JOIN dict_{c} ON dict_{c}.v = coalesce({source}.{c}, '{missing}')" for c in columns
    )


def index_columns(columns) -> str:
    return ", ".join(f"coalesce(dict_{c}.i, 0) AS {c}" for c in columns)


@query("k_label_encode_safe", f"""
WITH {ASSIGNED}, {index_ctes(CATEGORIES)}
SELECT patient_id, split, {index_columns(CATEGORIES)} FROM {index_joins(CATEGORIES, "assigned")}""")
def k_label_encode_safe(spark, folder):
    rows = assigned(spark, folder)
    dictionary = D.fit_label_dictionary(train_of(rows), CATEGORIES)
    return D.encode_labels(rows, dictionary, CATEGORIES).select(*IDS, *CATEGORIES)


@query("k_label_unseen", f"""
WITH {ASSIGNED},
levelled AS (SELECT patient_id, split, age || '|' || site_id || '|' || gender AS level FROM assigned),
dict_level AS (SELECT v, CAST(row_number() OVER (ORDER BY encode(v)) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT coalesce(level, 'Unknown') AS v FROM levelled WHERE split = 'train'))
SELECT patient_id, split, coalesce(i, 0) AS level, i IS NULL AS unseen
FROM levelled LEFT JOIN dict_level ON v = coalesce(level, 'Unknown')""")
def k_label_unseen(spark, folder):
    """Many levels, of which many are not in the training rows."""
    level = F.concat("age", F.lit("|"), "site_id", F.lit("|"), "gender")
    rows = assigned(spark, folder).withColumn("level", level)
    dictionary = D.fit_label_dictionary(train_of(rows), ["level"])
    known = train_of(rows).select(F.coalesce("level", F.lit("Unknown")).alias("known")).distinct()
    seen = rows.join(known, F.coalesce("level", F.lit("Unknown")) == F.col("known"), "left")
    encoded = D.encode_labels(seen, dictionary, ["level"])
    return encoded.select(*IDS, "level", F.col("known").isNull().alias("unseen"))


@query("k_label_encode", f"""
WITH {ASSIGNED}, {index_ctes(["gender", "site_id"], "nan")}
SELECT patient_id, split, {index_columns(["gender", "site_id"])}
FROM {index_joins(["gender", "site_id"], "assigned", "nan")}""")
def k_label_encode(spark, folder):
    rows = assigned(spark, folder)
    encoded = D.encode_categorical(rows, train_of(rows), ["gender", "site_id"], "label")
    return encoded.select(*IDS, "gender", "site_id")


@query("k_onehot", f"""
WITH {ASSIGNED}
SELECT patient_id, split, admissionweight, """ + ", ".join(
    f"CAST(ethnicity = '{v}' AS DOUBLE) AS \"ethnicity_{v}\""
    for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
) + ", " + ", ".join(
    f"CAST(coalesce(gender, 'nan') = '{v}' AS DOUBLE) AS \"gender_{v}\""
    for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "nan")
) + " FROM assigned")
def k_onehot(spark, folder):
    rows = assigned(spark, folder).select(*IDS, "admissionweight", "ethnicity", "gender")
    return D.encode_categorical(rows, train_of(rows), ["ethnicity", "gender"], "onehot")


def fill_sql(strategy: str, columns=NUMBERS) -> str:
    """CTE with one row of fills."""
    return "fills AS (SELECT " + ", ".join(f"{strategy.format(c=c)} AS {c}" for c in columns) + " FROM train)"


MEDIAN = "quantile_cont({c}, 0.5)"
FILLED = "filled AS (SELECT patient_id, split, mortality, " + ", ".join(
    f"coalesce(a.{c}, f.{c}) AS {c}" for c in NUMBERS
) + " FROM assigned a, fills f),\nfilled_train AS (SELECT * FROM filled WHERE split = 'train')"


def _imputed(spark, folder, strategy):
    rows = assigned(spark, folder)
    fills = X.fit_impute(train_of(rows), NUMBERS, strategy, constant=-1.0)
    return rounded(X.impute(rows, fills).select(*IDS, *NUMBERS))


def _impute_query(name, strategy, sql):
    @query(name, f"""
WITH {ASSIGNED}, {fill_sql(sql)}, {FILLED}
SELECT patient_id, split, {", ".join(r(c, c) for c in NUMBERS)} FROM filled""")
    def run(spark, folder):
        return _imputed(spark, folder, strategy)

    return run


k_impute_median = _impute_query("k_impute_median", "median", MEDIAN)
k_impute_mean = _impute_query("k_impute_mean", "mean", "avg({c})")
k_impute_constant = _impute_query("k_impute_constant", "constant", "min(CAST(-1 AS DOUBLE))")


def mode_sql(column: str, name: str) -> str:
    return (
        f"(SELECT {column} FROM train WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1) AS {name}"
    )


@query("k_impute_mode", f"""
WITH {ASSIGNED},
fills AS (SELECT {mode_sql("gender", "g")}, {mode_sql("age", "a")}, {mode_sql("admissionweight", "w")})
SELECT patient_id, split, coalesce(gender, g) AS gender, coalesce(age, a) AS age,
  {r("coalesce(admissionweight, w)", "admissionweight")}
FROM assigned, fills""")
def k_impute_mode(spark, folder):
    rows = assigned(spark, folder)
    columns = ["gender", "age", "admissionweight"]
    fills = X.most_frequent(train_of(rows), columns)
    return rounded(X.impute(rows, fills).select(*IDS, *columns))


def _scale_query(name, method, centre, width):
    pieces = ", ".join(f"{centre.format(c=c)} AS {c}_c, {width.format(c=c)} AS {c}_w" for c in NUMBERS)
    out = ", ".join(r(f"({c} - {c}_c) / CASE WHEN {c}_w = 0 THEN 1 ELSE {c}_w END", c) for c in NUMBERS)

    @query(name, f"""
WITH {ASSIGNED}, {fill_sql(MEDIAN)}, {FILLED}, fit AS (SELECT {pieces} FROM filled_train)
SELECT patient_id, split, {out} FROM filled, fit""")
    def run(spark, folder):
        rows = assigned(spark, folder)
        train = train_of(rows)
        found = X.moments(train, NUMBERS)
        fills = X.fit_impute(train, NUMBERS, "median", found=found)
        after = {c: X.after_fill(found[c], fills[c]) for c in NUMBERS}
        fitted = X.fit_scale(X.impute(train, fills), NUMBERS, method, after)
        return rounded(X.scale(X.impute(rows, fills), fitted).select(*IDS, *NUMBERS))

    return run


k_scale_standard = _scale_query("k_scale_standard", "standard", "avg({c})", "stddev_pop({c})")
k_scale_minmax = _scale_query("k_scale_minmax", "minmax", "min({c})", "max({c}) - min({c})")
k_scale_robust = _scale_query(
    "k_scale_robust", "robust", "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
)


@query("k_target_encode", f"""
WITH {ASSIGNED},
means AS (SELECT age, avg(mortality) AS m FROM train GROUP BY age),
means_g AS (SELECT gender, avg(mortality) AS m FROM train WHERE gender IS NOT NULL GROUP BY gender)
SELECT patient_id, split,
  {r("coalesce(means.m, (SELECT avg(m) FROM means))", "age")},
  {r("coalesce(means_g.m, (SELECT avg(m) FROM means_g))", "gender")}
FROM assigned LEFT JOIN means USING (age) LEFT JOIN means_g USING (gender)""")
def k_target_encode(spark, folder):
    rows = assigned(spark, folder)
    means = D.fit_target_means(train_of(rows), ["age", "gender"], "mortality")
    return rounded(D.encode_target(rows, means, ["age", "gender"]).select(*IDS, "age", "gender"))


def f_score_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, (ssb / (k - 1)) / (ssw / (n - k)) AS f_score FROM (
      SELECT count(*) AS k, sum(n) AS n, sum(n * var) AS ssw,
        sum(n * (m - grand) * (m - grand)) AS ssb
      FROM (SELECT mortality, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS var,
              (SELECT avg({c}) FROM filled_train) AS grand
            FROM filled_train GROUP BY mortality))"""


@query("k_select_f_classif", f"""
WITH {ASSIGNED}, {fill_sql(MEDIAN)}, {FILLED},
scores AS ({" UNION ALL ".join(f_score_sql(c) for c in NUMBERS)})
SELECT feature, {r("f_score", "f_score")}, row_number() OVER (ORDER BY f_score DESC) <= 2 AS selected
FROM scores""")
def k_select_f_classif(spark, folder):
    train = train_of(assigned(spark, folder))
    filled = X.impute(train, X.fit_impute(train, NUMBERS))
    scores = X.f_scores(filled, NUMBERS, "mortality")
    best = X.select_best(scores, "f_score", 2)
    return rounded(scores.select("feature", "f_score", F.col("feature").isin(best).alias("selected")))


def mutual_sql(c: str, bins: int = 10) -> str:
    cuts = "[" + ", ".join(
        f"(SELECT quantile_cont({c}, {i / bins}) FROM filled_train)" for i in range(1, bins)
    ) + "]"
    return f"""SELECT '{c}' AS feature, sum(n / n_all * ln(n * n_all / (n_bin * n_class))) AS mi FROM (
      SELECT CAST(n AS DOUBLE) AS n, sum(n) OVER () AS n_all, sum(n) OVER (PARTITION BY bin) AS n_bin,
        sum(n) OVER (PARTITION BY mortality) AS n_class
      FROM (SELECT bin, mortality, CAST(count(*) AS DOUBLE) AS n FROM (
        SELECT mortality, len(list_filter(list_distinct(cuts), lambda e: e < {c})) AS bin
        FROM filled_train, (SELECT {cuts} AS cuts)) GROUP BY ALL))"""


@query("k_select_mutual_info", f"""
WITH {ASSIGNED}, {fill_sql(MEDIAN)}, {FILLED},
scores AS ({" UNION ALL ".join(mutual_sql(c) for c in NUMBERS)})
SELECT feature, {r("mi", "mutual_info")} FROM scores""")
def k_select_mutual_info(spark, folder):
    train = train_of(assigned(spark, folder))
    filled = X.impute(train, X.fit_impute(train, NUMBERS))
    return rounded(X.mutual_information(filled, NUMBERS, "mortality").select("feature", "mutual_info"))


def digamma_sql(x: str) -> str:
    """From x + 20 downwards, in other steps than the library's."""
    y = f"({x} + 20)"
    return (f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6)"
            f" - list_sum(list_transform(range(20), lambda i: 1 / ({x} + i))))")


def neighbour_ctes(c: str, k: int = 3) -> str:
    """CTEs ending in mi_{c}: neighbours by rank among the rows of a class, counts by pairs."""
    far = ", ".join(f"abs({c} - {f}({c}, {i}) OVER w)" for f in ("lag", "lead") for i in range(1, k + 1))
    y = "CAST({} AS DOUBLE)"
    return f"""near_{c} AS (
  SELECT mortality, {c} AS x, count(*) OVER (PARTITION BY mortality) AS size,
    list_sort(list_filter([{far}], lambda d: d IS NOT NULL))[{k}] AS r
  FROM filled_train WINDOW w AS (PARTITION BY mortality ORDER BY {c})),
point_{c} AS (SELECT mortality, x, size, r, count(*) AS n FROM near_{c} GROUP BY ALL),
all_{c} AS (SELECT x, count(*) AS n FROM near_{c} GROUP BY x),
inside_{c} AS (
  SELECT p.mortality, p.x, p.size, p.n, {k} AS k, sum(o.n) AS m FROM point_{c} p JOIN all_{c} o
  ON o.x > p.x - p.r AND o.x < p.x + p.r WHERE p.r > 0 GROUP BY ALL
  UNION ALL SELECT p.mortality, p.x, p.size, p.n, p.n AS k, o.n AS m FROM point_{c} p JOIN all_{c} o USING (x) WHERE p.r = 0),
mi_{c} AS (SELECT '{c}' AS feature, greatest(0, {digamma_sql(y.format("sum(n)"))}
    + sum(n * ({digamma_sql(y.format("k"))} - {digamma_sql(y.format("size"))} - {digamma_sql(y.format("m"))})) / sum(n)) AS mi
  FROM inside_{c})"""


@query("k_select_mutual_info_knn", f"""
WITH {ASSIGNED}, {fill_sql(MEDIAN)}, {FILLED}, {", ".join(neighbour_ctes(c) for c in NUMBERS)}
SELECT feature, {r("mi", "mutual_info")} FROM ({" UNION ALL ".join(f"SELECT * FROM mi_{c}" for c in NUMBERS)})""")
def k_select_mutual_info_knn(spark, folder):
    """The imputed median makes many equal values."""
    train = train_of(assigned(spark, folder))
    filled = X.impute(train, X.fit_impute(train, NUMBERS))
    return rounded(N.neighbour_information(filled, NUMBERS, "mortality").select("feature", "mutual_info"))


def gaps_as_nan(df, column: str, present=None):
    """The column as DOUBLE with NaN for its gaps, and where ``present`` does not hold."""
    value = F.col(column).cast("double")
    value = value if present is None else F.when(present, value)
    return df.withColumn(column, F.coalesce(value, F.lit(float("nan"))))


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


@query("k_nan_is_missing", f"""
WITH {ASSIGNED}, {{predictions}},
dirty AS (SELECT * EXCLUDE (mortality), CASE WHEN patientunitstayid % 13 <> 0 THEN mortality END AS mortality FROM train),
filled_train AS (SELECT * FROM dirty WHERE mortality IS NOT NULL),
scored AS (SELECT * FROM predictions WHERE CAST(patient_id AS BIGINT) % 7 <> 0 AND CAST(patient_id AS BIGINT) % 11 <> 0),
{ROC.replace("FROM predictions", "FROM scored")}, {GRID.replace("FROM predictions", "FROM scored")},
found AS (
SELECT 'f_score' AS what, feature AS name, f_score AS value FROM ({_union(f_score_sql(c) for c in NUMBERS)})
UNION ALL SELECT 'mutual_info', feature, mi FROM ({_union(
    mutual_sql(c).replace("FROM filled_train, (", f"FROM (SELECT * FROM filled_train WHERE {c} IS NOT NULL), (")
    .replace("FROM filled_train)", "FROM dirty)") for c in NUMBERS)})
UNION ALL SELECT 'class_weight', CAST(mortality AS VARCHAR), sum(count(*)) OVER () / CAST(count(*) OVER () * count(*) AS DOUBLE)
  FROM filled_train GROUP BY mortality
UNION ALL SELECT 'imbalance', 'ratio', min(n) FILTER (mortality IS NOT NULL) / CAST(sum(n) AS DOUBLE)
  FROM (SELECT mortality, count(*) AS n FROM dirty GROUP BY mortality)
UNION ALL SELECT 'share', CAST(mortality AS VARCHAR), count(*) * 100.0 / (SELECT count(*) FROM dirty) FROM filled_train GROUP BY mortality
UNION ALL SELECT 'mode', 'admissionweight', {mode_sql("admissionweight", "w")}
UNION ALL SELECT 'levels', 'heartrate_mean', count(DISTINCT heartrate_mean) + max((heartrate_mean IS NULL)::INT) FROM dirty
UNION ALL SELECT 'slots', 'heartrate_mean', count(DISTINCT heartrate_mean) + max((heartrate_mean IS NULL)::INT) FROM dirty
UNION ALL SELECT 'target_mean', 'heartrate_mean', avg(m) FROM
  (SELECT avg(mortality) AS m FROM dirty WHERE heartrate_mean IS NOT NULL GROUP BY heartrate_mean)
UNION ALL (SELECT 'youden', 'value', tp / CAST((SELECT sum(pos) FROM points) AS DOUBLE) - fp / CAST((SELECT sum(neg) FROM points) AS DOUBLE) AS j
  FROM roc ORDER BY j DESC LIMIT 1)
UNION ALL SELECT 'f1', 'value', max(2 * tp / (p + tp + fp)) FROM cells
UNION ALL SELECT 'balanced_accuracy', 'value', max((tp / p + (n - fp) / n) / 2) FROM cells)
SELECT what, name, {r("value", "value")} FROM found""")
def k_nan_is_missing(spark, folder):
    """Every fit, score and report on tables whose gaps are NaN, against SQL on NULLs."""
    rows = assigned(spark, folder)
    for c in NUMBERS:
        rows = gaps_as_nan(rows, c)
    train = train_of(gaps_as_nan(rows, "mortality", F.col("patientunitstayid") % 13 != 0))
    number = F.col("patient_id").cast("long")
    scored = gaps_as_nan(V.predictions(spark, folder), "y_pred_proba", number % 7 != 0)
    scored = gaps_as_nan(scored, "y_true", number % 11 != 0)

    def part(what, df, name, value):
        return df.select(F.lit(what).alias("what"), name.cast("string").alias("name"), value.cast("double").alias("value"))

    whole = F.col("class").cast("int")
    one = lambda name: F.lit(name)
    parts = [
        part("f_score", X.f_scores(train, NUMBERS, "mortality"), F.col("feature"), F.col("f_score")),
        part("mutual_info", X.mutual_information(train, NUMBERS, "mortality"), F.col("feature"), F.col("mutual_info")),
        part("class_weight", E.class_weights(train, "mortality"), whole, F.col("weight")),
        part("imbalance", E.class_imbalance(train, "mortality"), one("ratio"), F.col("minority_ratio")),
        part("share", Q.value_distribution(train, "mortality"), F.col("value").cast("int"), F.col("percent")),
        spark.createDataFrame([("mode", "admissionweight", X.most_frequent(train, ["admissionweight"])["admissionweight"])],
                              "what STRING, name STRING, value DOUBLE"),
        part("levels", D.fit_label_dictionary(train, ["heartrate_mean"]).agg(F.count("*").alias("n")), one("heartrate_mean"), F.col("n")),
        part("slots", D.fit_one_hot_slots(train, ["heartrate_mean"]).agg(F.count("*").alias("n")), one("heartrate_mean"), F.col("n")),
        part("target_mean", D.fit_target_means(train, ["heartrate_mean"], "mortality").agg(F.avg("mean").alias("m")), one("heartrate_mean"), F.col("m")),
        *[part(m, E.optimal_threshold(scored, m), one("value"), F.col("value")) for m in E.METRICS],
    ]
    return rounded(reduce(lambda a, b: a.unionByName(b), parts))


@query("k_onehot_sparse", f"""
WITH {ASSIGNED},
levels AS (SELECT DISTINCT 0 AS place, age AS v FROM train UNION SELECT 1, coalesce(gender, 'nan') FROM train
  UNION SELECT 2, site_id FROM train),
slots AS (SELECT place, v, row_number() OVER (ORDER BY place, v = 'nan', encode(v)) - 1 AS i FROM levels)
SELECT patient_id, split, admissionweight, concat_ws(',', a.i, g.i, s.i) AS slots,
  CAST((a.i IS NOT NULL)::INT + (g.i IS NOT NULL)::INT + (s.i IS NOT NULL)::INT AS DOUBLE) AS total
FROM assigned LEFT JOIN slots a ON a.place = 0 AND a.v = age LEFT JOIN slots g ON g.place = 1 AND g.v = coalesce(gender, 'nan')
  LEFT JOIN slots s ON s.place = 2 AND s.v = site_id""")
def k_onehot_sparse(spark, folder):
    """Slots of the levels instead of a column a level."""
    columns = ["age", "gender", "site_id"]
    rows = assigned(spark, folder).select(*IDS, "admissionweight", *columns)
    sparse = D.encode_one_hot_sparse(rows, D.fit_one_hot_slots(train_of(rows), columns), columns)
    total = F.aggregate("one_hot_values", F.lit(0.0), lambda a, x: a + x)
    return sparse.select(*IDS, "admissionweight", F.array_join(F.col("one_hot_indices").cast("array<string>"), ",").alias("slots"), total.alias("total"))


@query("k_train_only_pipeline", f"""
WITH {ASSIGNED}, {fill_sql(MEDIAN)}, {FILLED},
modes AS (SELECT {mode_sql("gender", "g")}),
texts AS (SELECT patient_id, coalesce(gender, g) AS gender, ethnicity FROM assigned, modes),
means AS (SELECT gender, avg(mortality) AS m FROM texts JOIN filled_train USING (patient_id) GROUP BY gender),
fit AS (SELECT {", ".join(f"avg({c}) AS {c}_c, stddev_pop({c}) AS {c}_w" for c in NUMBERS)} FROM filled_train),
best AS (SELECT feature FROM ({" UNION ALL ".join(f_score_sql(c) for c in NUMBERS)})
  ORDER BY f_score DESC LIMIT 2)
SELECT patient_id, split, feature,
  {r("CASE feature " + " ".join(f"WHEN '{c}' THEN ({c} - {c}_c) / {c}_w" for c in NUMBERS) + " END", "value")},
  {r("coalesce(m, (SELECT avg(m) FROM means))", "gender")}, ethnicity
FROM filled JOIN texts USING (patient_id) LEFT JOIN means USING (gender), fit, best""")
def k_train_only_pipeline(spark, folder):
    """All steps in order; the selected numbers are shown long, one row per feature."""
    rows = assigned(spark, folder)
    fitted = X.Preprocessor(
        NUMBERS, ["gender", "ethnicity"], target_encode=["gender"], label="mortality",
        feature_selection="f_classif", n_features=2,
    ).fit(train_of(rows))
    features = fitted.transform(rows, keep=IDS)
    ids = [*IDS, "gender", "ethnicity"]
    return rounded(features.unpivot(ids, fitted.selected, "feature", "value"))


@query("k_sample_weight", f"""
WITH {ASSIGNED},
weights AS (SELECT mortality, sum(count(*)) OVER () / CAST(count(*) OVER () * count(*) AS DOUBLE) AS w
  FROM train GROUP BY mortality)
SELECT patient_id, split, mortality, {r("w", "sample_weight")} FROM assigned JOIN weights USING (mortality)""")
def k_sample_weight(spark, folder):
    rows = assigned(spark, folder).select(*IDS, "mortality")
    return rounded(E.sample_weights(rows, train_of(rows), "mortality"))


STATS_SQL = {
    "mean": "avg({c})", "std": "stddev_samp({c})", "median": "quantile_cont({c}, 0.5)",
    "q25": "quantile_cont({c}, 0.25)", "q75": "quantile_cont({c}, 0.75)", "min": "min({c})", "max": "max({c})",
}


@query("k_train_stats", f"WITH {ASSIGNED}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", " + ", ".join(r(e.format(c=c), f'"{n}"') for n, e in STATS_SQL.items())
    + " FROM train" for c in NUMBERS
))
def k_train_stats(spark, folder):
    stats = X.fit_train_stats(train_of(assigned(spark, folder)), NUMBERS)
    rows = [(c, *[s[n] for n in X.TRAIN_STATS]) for c, s in stats.items()]
    schema = "column STRING, " + ", ".join(f"{n} DOUBLE" for n in X.TRAIN_STATS)
    return rounded(spark.createDataFrame(rows, schema))


@query("k_train_deviation_iqr", f"""
WITH {ASSIGNED}, fit AS (SELECT {", ".join(
    f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s, quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.75) AS {c}_b"
    for c in NUMBERS)} FROM train)
SELECT patient_id, split, {", ".join(
    r(f"({c} - {c}_m) / ({c}_s + CAST(1e-8 AS DOUBLE))", f"{c}_deviation_from_train_mean")
    + f", CASE WHEN {c} BETWEEN {c}_a AND {c}_b THEN 1 ELSE 0 END AS {c}_within_train_iqr"
    for c in NUMBERS)}
FROM assigned, fit""")
def k_train_deviation_iqr(spark, folder):
    rows = assigned(spark, folder).select(*IDS, *NUMBERS)
    return rounded(X.add_train_features(rows, X.fit_train_stats(train_of(rows), NUMBERS)).drop(*NUMBERS))
