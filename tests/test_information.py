"""Mutual information by nearest neighbours against a plain version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.functions.numeric import digamma
from cohortkit.operators.neighbours import neighbour_information
from cohortkit.operators.transforms import Preprocessor


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def plain(x, y, k=3):
    """All pairs of distances."""
    keep = np.array([np.sum(y == c) > 1 for c in y]) & ~np.isnan(x)
    keep &= np.array([np.sum((y == c) & ~np.isnan(x)) > 1 for c in y])
    x, y = x[keep], y[keep]
    if not len(x):
        return None
    terms = []
    for i in range(len(x)):
        same = np.sort(np.abs(x[(y == y[i]) & (np.arange(len(x)) != i)] - x[i]))
        r = same[min(k, len(same)) - 1]
        if r > 0:
            kk, m = min(k, len(same)), np.sum((x > x[i] - r) & (x < x[i] + r))
        else:
            kk, m = np.sum((y == y[i]) & (x == x[i])), np.sum(x == x[i])
        terms.append(psi(kk) - psi(np.sum(y == y[i])) - psi(m))
    return max(0.0, psi(len(x)) + float(np.mean(terms)))


def test_digamma(spark):
    got = [r[0] for r in spark.range(1, 60).select(digamma(F.col("id").cast("double"))).collect()]
    assert got == [pytest.approx(psi(n), abs=1e-10) for n in range(1, 60)]
    assert spark.range(1).select(digamma(F.lit(1e9))).first()[0] == pytest.approx(math.log(1e9) - 0.5e-9, abs=1e-12)


@pytest.mark.parametrize("range_rows", [25, 10**6])
def test_equals_all_pairs(spark, range_rows):
    rng = np.random.default_rng(8)
    n = 400
    y = rng.integers(0, 3, n)
    y[:2] = (7, 8)  # classes of one row
    columns = {
        "apart": y + 0.3 * rng.standard_normal(n), "noise": rng.standard_normal(n), "few": rng.integers(0, 6, n).astype(float),
        "half": np.where(rng.random(n) < 0.5, 2.0, rng.standard_normal(n)), "same": np.full(n, 4.0),
        "gaps": np.where(rng.random(n) < 0.4, np.nan, y * 2.0 + rng.random(n)), "none": np.full(n, np.nan),
    }
    names = list(columns)
    rows = [(int(y[i]), *[float(columns[c][i]) for c in names]) for i in range(n)]
    df = spark.createDataFrame(rows, "y INT, " + ", ".join(f"{c} DOUBLE" for c in names))
    got = {r["feature"]: r["mutual_info"] for r in neighbour_information(df, names, "y", range_rows=range_rows).collect()}
    for c in names:
        want = plain(columns[c], y)
        assert got[c] == (want if want is None else pytest.approx(want, abs=1e-9)), c
    assert got["apart"] > 0.5 and got["noise"] < 0.1 and got["same"] == 0


def test_selects_by_it(spark):
    df = spark.range(300).select((F.col("id") % 2).cast("int").alias("y"), F.sin("id").alias("noise"), (F.col("id") % 2 + F.col("id") / 1000).alias("told"))
    fitted = Preprocessor(["noise", "told"], label="y", feature_selection="mutual_info_knn", n_features=1).fit(df)
    assert fitted.selected == ["told"]
