"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def first_row(row: str) -> Column:
    """One of a group's rows (structs): the first by its JSON form. Merged before the shuffle."""
    return F.min_by(row, F.to_json(row))


def rows_of(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names.

    Extra columns of the input, whatever they are called, never meet the operator's.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def release_memory() -> None:
    """Give a Python worker's free memory back: workers outlive tasks and share an
    executor's memory with its JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
