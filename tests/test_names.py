"""Column names made from data survive every step, files included."""

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import features as T
from cohortkit.operators import quality as Q
from cohortkit.operators import transforms as X
from cohortkit.plans.train_ready import dual_tower
from cohortkit.session import materialize

NAMES = ["O2 Sat (%)", "T4, free", "Fe/TIBC", "a.b", "x=y;z", "tick`s", "-basos", "HIV 1&2"]


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(i, n, float(i * (j + 1) % 7), i) for i in range(40) for j, n in enumerate(NAMES)]
    lab = spark.createDataFrame(rows, "patientunitstayid LONG, labname STRING, labresult DOUBLE, labresultoffset INT")
    return materialize(T.aggregate_and_pivot(lab))


def test_pivoted_names(wide):
    assert wide.columns[1:] == [f"lab_{n}_{s}" for n in sorted(NAMES) for s in ("mean", "std")]
    assert wide.count() == 40


def test_packs_of_such_columns(spark, wide):
    means = [c for c in wide.columns if c.endswith("_mean")]
    rows = wide.select("patientunitstayid", *[F.col("`" + c.replace("`", "``") + "`") for c in means]).withColumns({
        "patient_id": F.col("patientunitstayid").cast("string"),
        "mortality": (F.col("patientunitstayid") % 2).cast("int"),
        "age": F.lit("1"),
        "split": F.when(F.col("patientunitstayid") < 30, "train").otherwise("test"),
    })
    packs = materialize(dual_tower(rows))
    assert packs.columns == ["patient_id", "split", "mortality", "age", *means]
    fitted = X.Preprocessor(means, ["age"], label="mortality", feature_selection="f_classif", n_features=3).fit(rows)
    assert len(fitted.transform(rows).columns) == 4
    stats = X.fit_train_stats(rows, means)
    assert len(X.add_train_features(rows, stats).columns) == len(rows.columns) + 2 * len(means)
    assert Q.describe(rows, means).count() == len(means)
    assert Q.target_correlations(rows, "mortality").count() >= 1
    assert Q.duplicate_rows(rows).first()["n_duplicates"] == 0
