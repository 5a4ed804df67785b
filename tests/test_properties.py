"""Rules that hold for any input."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortkit.operators import quantiles as Q
from cohortkit.operators import splits as S

QUICK = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@given(st.dictionaries(st.integers(0, 6), st.integers(2, 500), min_size=1), st.sampled_from([0.1, 0.125, 0.2, 0.3, 0.5]))
def test_held_out_keeps_shares(counts, fraction):
    n = sum(counts.values())
    n_out = math.ceil(n * fraction)
    if min(n_out, n - n_out) < len(counts):
        with pytest.raises(ValueError):
            S.held_out(counts, fraction)
        return
    out = S.held_out(counts, fraction)
    assert sum(out.values()) == n_out
    for c, k in out.items():
        share = Fraction(counts[c] * n_out, n)
        assert math.floor(share) <= k <= math.ceil(share) and 0 <= k <= counts[c]


@QUICK
@given(
    st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.integers(0, 3).map(float)), min_size=1, max_size=60),
    st.integers(1, 40),
)
def test_quantiles_of_any_column(spark, values, bracket_rows):
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got = Q.exact_quantiles(df, ["x"], [0.0, 0.3, 0.5, 1.0], bracket_rows=bracket_rows)["x"]
    present = [v for v in values if v is not None]
    for p, v in got.items():
        assert v is None if not present else v == pytest.approx(np.quantile(present, p), rel=1e-9, abs=1e-9)


@QUICK
@given(st.lists(st.integers(0, 1), min_size=30, max_size=80), st.integers(0, 1000))
def test_splits_of_any_labels(spark, labels, seed):
    if min(labels.count(0), labels.count(1)) < 2:
        return
    rows = [(str(i), "s", y) for i, y in enumerate(labels)]
    df = spark.createDataFrame(rows, "patient_id STRING, site_id STRING, mortality INT")
    got = S.split_by_entity(df, seed=seed).collect()
    assert sorted(int(r["patient_id"]) for r in got) == list(range(len(labels)))
    want = S.held_out({y: labels.count(y) for y in set(labels)}, 0.2)
    for y, k in want.items():
        assert sum(1 for r in got if r["split"] == "test" and r["mortality"] == y) == k
