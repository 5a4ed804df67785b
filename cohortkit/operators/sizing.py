"""Measured sizes decide between a broadcast and a shuffle join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from cohortkit.functions.names import col
from cohortkit.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS


def within_broadcast(rows: int, size: int) -> bool:
    return rows <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES


def measured_small(df: DataFrame) -> bool:
    """True when the table was counted to be below the broadcast bounds."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 16 * len(df.columns)
    width = sum((F.coalesce(F.octet_length(col(c)), F.lit(0)) for c in text), F.lit(fixed))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return within_broadcast(row["n"], row["b"] or 0)


def small_side(df: DataFrame) -> DataFrame:
    """Hint a broadcast if the table is small; otherwise leave the choice to Spark.

    Without the hint Spark shuffles both sides and splits hot keys at run time.
    """
    return F.broadcast(df) if measured_small(df) else df
