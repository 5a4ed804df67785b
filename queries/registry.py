"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from cohortkit.functions.names import col
from queries.views import VIEW_SQL

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
PLACES = 6


def query(name: str, sql: str | None = None):
    """Register a query. In the SQL, ``{view}`` stands for the definition of a view."""

    def register(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql is not None:
            text = sql
            for view, definition in VIEW_SQL.items():
                text = text.replace("{" + view + "}", definition)
            SQL[name] = text
        return function

    return register


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Both engines add up in their own order; compare to six places."""
    return df.select(*[
        (F.round(col(f.name), places) if f.dataType.typeName() == "double" else col(f.name)).alias(f.name)
        for f in df.schema.fields
    ])


def r(expression: str, name: str | None = None) -> str:
    """The SQL for a rounded column; adding zero turns -0 into 0."""
    return f"round({expression}, {PLACES}) + CAST(0 AS DOUBLE)" + (f" AS {name}" if name else "")
