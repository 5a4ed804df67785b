"""Predictions, thresholds, class balance."""

from __future__ import annotations

from cohortkit.operators import evaluate as E
from cohortkit.operators.cohort import add_label
from queries import views as V
from queries.cohort_queries import LABEL_SQL
from queries.registry import query, r, rounded


@query("c_merge_predictions", """
WITH {predictions}
SELECT patient_id, y_true, y_pred_proba, CASE WHEN y_pred_proba >= 0.5 THEN 1 ELSE 0 END AS y_pred_class
FROM predictions""")
def c_merge_predictions(spark, folder):
    scored = V.predictions(spark, folder)
    return E.merge_predictions(
        scored.select("patient_id", "y_true"), scored.select("patient_id", "y_pred_proba")
    )


ROC = """points AS (
  SELECT y_pred_proba AS threshold, sum(y_true) AS pos, count(*) - sum(y_true) AS neg
  FROM predictions GROUP BY ALL),
roc AS (
  SELECT threshold, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
    CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp
  FROM points)"""


@query("m_roc_points", f"""
WITH {{predictions}}, {ROC}
SELECT * FROM roc""")
def m_roc_points(spark, folder):
    return E.roc_points(V.predictions(spark, folder))


@query("m_threshold_youden", f"""
WITH {{predictions}}, {ROC},
scored AS (
  SELECT threshold, tp / CAST((SELECT sum(pos) FROM points) AS DOUBLE)
    - fp / CAST((SELECT sum(neg) FROM points) AS DOUBLE) AS j FROM roc
  UNION ALL SELECT CAST('inf' AS DOUBLE), 0)
SELECT threshold, {r("j", "value")} FROM scored ORDER BY j DESC, threshold DESC LIMIT 1""")
def m_threshold_youden(spark, folder):
    return rounded(E.optimal_threshold(V.predictions(spark, folder), "youden"))


GRID = """grid AS (SELECT CASE WHEN i = 99 THEN 1.0 ELSE i * (CAST(1 AS DOUBLE) / 99) END AS threshold
  FROM range(100) t(i)),
cells AS (
  SELECT threshold,
    CAST(count(*) FILTER (y_true = 1 AND y_pred_proba >= threshold) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (y_true = 0 AND y_pred_proba >= threshold) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (y_true = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (y_true = 0) AS DOUBLE) AS n
  FROM predictions, grid GROUP BY threshold)"""


@query("m_threshold_f1", f"""
WITH {{predictions}}, {GRID}
SELECT {r("threshold", "threshold")}, {r("2 * tp / (p + tp + fp)", "value")} FROM cells
ORDER BY 2 * tp / (p + tp + fp) DESC, cells.threshold LIMIT 1""")
def m_threshold_f1(spark, folder):
    return rounded(E.optimal_threshold(V.predictions(spark, folder), "f1"))


@query("m_threshold_balanced", f"""
WITH {{predictions}}, {GRID}
SELECT {r("threshold", "threshold")}, {r("(tp / p + (n - fp) / n) / 2", "value")} FROM cells
ORDER BY (tp / p + (n - fp) / n) / 2 DESC, cells.threshold LIMIT 1""")
def m_threshold_balanced(spark, folder):
    return rounded(E.optimal_threshold(V.predictions(spark, folder), "balanced_accuracy"))


LABELLED = f"labelled AS (SELECT {LABEL_SQL} AS mortality FROM patient)"


@query("d_class_weight", f"""
WITH {{patient}}, {LABELLED}
SELECT mortality AS "class", count(*) AS n,
  {r("sum(count(*)) OVER () / CAST(count(*) OVER () * count(*) AS DOUBLE)", "weight")}
FROM labelled GROUP BY mortality""")
def d_class_weight(spark, folder):
    return rounded(E.class_weights(add_label(V.patient(spark, folder)), "mortality"))


@query("d_class_weight_inverse", f"""
WITH {{patient}}, {LABELLED}
SELECT mortality AS "class", count(*) AS n,
  {r("sum(count(*)) OVER () / CAST(count(*) AS DOUBLE)", "weight")}
FROM labelled GROUP BY mortality""")
def d_class_weight_inverse(spark, folder):
    return rounded(E.class_weights(add_label(V.patient(spark, folder)), "mortality", "inverse"))


@query("d_class_imbalance", f"""
WITH sizes AS (SELECT toxic, count(*) AS n FROM labels GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, min(n) AS n_minority,
  {r("min(n) / CAST(sum(n) AS DOUBLE)", "minority_ratio")}, min(n) / CAST(sum(n) AS DOUBLE) < 0.2 AS imbalanced
FROM sizes""")
def d_class_imbalance(spark, folder):
    return rounded(E.class_imbalance(V.table(spark, folder, "labels"), "toxic"))
