"""What the physical plans must and must not hold."""

import re

from pyspark.sql import functions as F

from cohortkit.operators import cohort as C
from cohortkit.operators import features as T
from cohortkit.operators import quality as Q
from cohortkit.session import materialize
from queries import views as V


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(V.table(spark, small, "lineitem").where(F.col("l_quantity").between(0, 10)).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual" in text
    vital = T.in_window(V.vital(spark, small), "observationoffset")
    text = plan(T.aggregate_wide(vital, value_cols=["heartrate"]))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:\w+>", text)


def test_all_vital_statistics_share_one_shuffle(spark, small):
    text = plan(T.aggregate_wide(V.vital(spark, small)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in text and "Window" not in text


def test_cohort_meets_raw_rows_only_when_small(spark, small):
    """Broadcast: the semi join is below the aggregate. Otherwise it is above it."""
    keys = materialize(C.matching_keys(V.diagnosis(spark, small), keywords=V.WORDS))

    def order():
        wide = T.aggregate_wide(V.vital(spark, small)).join(keys, "patientunitstayid", "left_semi")
        text = plan(wide)
        return text.index("LeftSemi") < text.index("partial_avg")

    assert not order()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert order()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pivot_moves_narrow_rows(spark, small):
    text = plan(T.aggregate_and_pivot(V.lab(spark, small)))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("partial_collect_list") < text.index("Exchange hashpartitioning")


def test_semi_join_merges_keys_before_the_shuffle(spark, small):
    text = plan(C.matching_keys(V.diagnosis(spark, small), keywords=V.WORDS))
    assert text.count("HashAggregate(keys=[patientunitstayid") == 2


def test_duplicates_merge_before_the_shuffle(spark, small):
    text = plan(Q.duplicate_rows(V.diagnosis(spark, small)))
    assert text.count("partial_count") >= 1


def test_one_partition_only_for_totals(spark, small):
    """A single-partition exchange may only carry one partial row per task."""
    for df in (
        Q.duplicate_rows(V.diagnosis(spark, small)),
        Q.target_correlations(V.vital(spark, small), "sao2"),
        Q.id_structure(V.vital(spark, small), "patientunitstayid"),
    ):
        lines = plan(df).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "partial_" in lines[i + 1] or "merge_" in lines[i + 1]
