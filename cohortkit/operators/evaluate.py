"""Scored rows: predictions, thresholds, class balance and weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortkit.constants import IMBALANCE_RATIO, THRESHOLD_GRID
from cohortkit.functions.names import col
from cohortkit.functions.numeric import known, present
from cohortkit.operators.running import running_totals
from cohortkit.operators.sizing import small_side
from cohortkit.session import keep, materialize

METRICS = ("youden", "f1", "balanced_accuracy")


def merge_predictions(
    truth: DataFrame, scores: DataFrame, key: str = "patient_id", threshold: float = 0.5
) -> DataFrame:
    """Truth and score of each key with the class at a threshold (none for a missing score).

    A key that a table has more than once is an error when the rows are computed. Counting
    its rows takes no shuffle besides the join's own.
    """
    joined = _one_each(truth, key, "y_true").join(_one_each(scores, key, "y_pred_proba"), key)
    return joined.withColumn("y_pred_class", (present(F.col("y_pred_proba")) >= threshold).cast("int"))


def _one_each(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of every key; a repeated key fails by name."""
    rows = df.where(col(key).isNotNull()).groupBy(col(key)).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(col(value)).alias("__value"))
    message = F.concat(F.lit(f"'{key}' repeats: "), col(key).cast("string"))
    dtype = df.schema[value].dataType
    return rows.select(
        col(key), F.when(F.col("__n") == 1, F.col("__value")).otherwise(F.raise_error(message).cast(dtype)).alias(value))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(class, n) of the present labels."""
    label_ = known(df, label)
    return df.where(label_.isNotNull()).groupBy(label_.alias("class")).agg(F.count(F.lit(1)).alias("n"))


def class_imbalance(df: DataFrame, label: str, threshold: float = IMBALANCE_RATIO) -> DataFrame:
    """(n_rows, n_minority, minority_ratio, imbalanced); the ratio is of all rows."""
    groups = df.groupBy(known(df, label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    sizes = groups.agg(
        F.sum("n").alias("n_rows"),
        F.min(F.when(F.col("class").isNotNull(), F.col("n"))).alias("n_minority"),
    )
    ratio = F.try_divide(F.col("n_minority").cast("double"), F.col("n_rows").cast("double"))
    return sizes.withColumn("minority_ratio", ratio).withColumn(
        "imbalanced", F.col("minority_ratio") < threshold
    )


def class_weights(train: DataFrame, label: str, method: str = "balanced") -> DataFrame:
    """(class, n, weight): ``balanced`` n_all/(classes*n), ``inverse`` n_all/n."""
    if method not in ("balanced", "inverse"):
        raise ValueError(f"unknown weighting method: {method}")
    counts = class_counts(train, label)
    # One row per class meets here.
    everything = Window.partitionBy()
    total = F.sum("n").over(everything).cast("double")
    classes = F.count(F.lit(1)).over(everything) if method == "balanced" else F.lit(1)
    return counts.withColumn("weight", total / (classes * F.col("n")))


def sample_weights(df: DataFrame, train: DataFrame, label: str, method: str = "balanced") -> DataFrame:
    """Each row with the weight of its class."""
    weights = keep(class_weights(train, label, method).select(
        F.col("class").alias("__class"), F.col("weight").alias("sample_weight")
    ))
    return df.join(small_side(weights), col(label) == F.col("__class")).drop("__class")


def _positives(df: DataFrame, label: str, score: str) -> tuple[Column, list[Column]]:
    label_ = known(df, label)
    positive = label_ == 1
    return present(col(score)).isNotNull() & label_.isNotNull(), [
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"),
    ]


def _merged_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, pos, neg): one row per distinct score, written once."""
    usable, totals = _positives(df, label, score)
    by_score = df.where(usable).groupBy(col(score).cast("double").alias("threshold"))
    return materialize(by_score.agg(*totals))


def _class_sizes(merged: DataFrame) -> tuple[int, int]:
    """How many positives and negatives there are."""
    row = merged.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    return row["p"] or 0, row["n"] or 0


def _accumulated(merged: DataFrame) -> DataFrame:
    return running_totals(merged, "threshold", {"tp": "pos", "fp": "neg"}, descending=True)


def roc_points(df: DataFrame, label: str = "y_true", score: str = "y_pred_proba") -> DataFrame:
    """(threshold, pos, neg, tp, fp): what lies at or above each distinct score.

    Rows of one score are merged first; the running sums go over distinct scores.
    """
    return _accumulated(_merged_scores(df, label, score))


def youden_threshold(df: DataFrame, label: str = "y_true", score: str = "y_pred_proba") -> DataFrame:
    """(threshold, value): highest true minus false positive rate, ties to the highest threshold.

    When no score beats accepting nothing, the threshold is infinite and the value 0.
    """
    merged = _merged_scores(df, label, score)
    p, n = _class_sizes(merged)
    j = F.try_divide(F.col("tp").cast("double"), F.lit(p)) - F.try_divide(F.col("fp").cast("double"), F.lit(n))
    best = _accumulated(merged).select("threshold", j.alias("value")).agg(
        F.max(F.struct("value", "threshold")).alias("best")
    )
    beaten = F.col("best.value") > 0
    return best.select(
        F.when(beaten, F.col("best.threshold")).otherwise(F.lit(math.inf)).alias("threshold"),
        F.when(beaten, F.col("best.value")).otherwise(F.lit(0.0)).alias("value"),
    )


def grid_points(
    df: DataFrame, label: str = "y_true", score: str = "y_pred_proba", size: int = THRESHOLD_GRID
) -> DataFrame:
    """(slot, threshold, tp, fp, p, n) for evenly spaced thresholds from 0 to 1.

    Each score is put on the highest threshold it reaches, found by a guess and a
    comparison with its neighbours. After that there are ``size`` rows.
    """
    step = 1.0 / (size - 1)

    def at(slot: Column) -> Column:
        return F.when(slot == size - 1, F.lit(1.0)).otherwise(slot.cast("double") * F.lit(step))

    p = col(score).cast("double")
    guess = F.floor(p * (size - 1)).cast("int")
    inside_ = F.when(p >= at(guess + 1), guess + 1).when(p >= at(guess), guess).otherwise(guess - 1)
    slot = F.when(p < 0, -1).when(p >= 1, size - 1).otherwise(inside_)
    usable, totals = _positives(df, label, score)
    reached = keep(df.where(usable).select(slot.alias("slot"), label).groupBy("slot").agg(*totals))
    n_pos, n_neg = _class_sizes(reached)
    grid = df.sparkSession.range(size).select(F.col("id").cast("int").alias("slot"))
    above = Window.partitionBy().orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(reached, "slot", "left").select(
        "slot",
        at(F.col("slot")).alias("threshold"),
        F.sum(F.coalesce("pos", F.lit(0))).over(above).alias("tp"),
        F.sum(F.coalesce("neg", F.lit(0))).over(above).alias("fp"),
        F.lit(n_pos).alias("p"),
        F.lit(n_neg).alias("n"),
    )


def grid_threshold(
    df: DataFrame, metric: str, label: str = "y_true", score: str = "y_pred_proba"
) -> DataFrame:
    """(threshold, value): best F1 or balanced accuracy on the grid, ties to the lowest threshold."""
    tp, fp, p, n = (F.col(c).cast("double") for c in ("tp", "fp", "p", "n"))
    if metric == "f1":
        value = F.coalesce(F.try_divide(2 * tp, p + tp + fp), F.lit(0.0))
    else:
        # A class that does not occur is left out of the mean.
        value = (
            F.when(p == 0, F.try_divide(n - fp, n))
            .when(n == 0, F.try_divide(tp, p))
            .otherwise((F.try_divide(tp, p) + F.try_divide(n - fp, n)) / 2)
        )
    best = grid_points(df, label, score).select("threshold", value.alias("value")).agg(
        F.min(F.struct((-F.col("value")).alias("lost"), "threshold")).alias("best")
    )
    return best.select(F.col("best.threshold").alias("threshold"), (-F.col("best.lost")).alias("value"))


def optimal_threshold(
    df: DataFrame, metric: str = "youden", label: str = "y_true", score: str = "y_pred_proba"
) -> DataFrame:
    """(threshold, value) that is best by the metric."""
    if metric not in METRICS:
        raise ValueError(f"unknown threshold metric: {metric}")
    if metric == "youden":
        return youden_threshold(df, label, score)
    return grid_threshold(df, metric, label, score)


def classification_metrics(
    predictions: DataFrame, by: tuple[str, ...] = (), truth: str = "y_true", predicted: str = "y_pred_class"
) -> DataFrame:
    """Long metrics (…by, metric, value) of scored classes, for the summary table."""
    yes, said = known(predictions, truth) == 1, known(predictions, predicted) == 1
    cells = predictions.groupBy(*by).agg(
        F.count_if(yes & said).cast("double").alias("tp"),
        F.count_if(~yes & said).cast("double").alias("fp"),
        F.count_if(yes & ~said).cast("double").alias("fn"),
        F.count_if(~yes & ~said).cast("double").alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    measures = cells.select(
        *by,
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
    )
    return measures.unpivot(list(by), ["accuracy", "precision", "recall"], "metric", "value")
