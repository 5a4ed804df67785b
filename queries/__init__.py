"""Registered queries and the SQL that must give the same rows."""

from queries import (  # noqa: F401  (importing registers)
    cohort_queries,
    evaluate_queries,
    feature_queries,
    pipeline_queries,
    quality_queries,
    source_queries,
    split_queries,
    transform_queries,
)
from queries.registry import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
