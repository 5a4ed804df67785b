"""Decisions about columns: missing ratios, sparse columns, kinds and roles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.constants import (
    CATEGORICAL_COLUMNS,
    LABEL,
    LEAKAGE_COLUMNS,
    MAX_CATEGORICAL_LEVELS,
    MISSING_THRESHOLD,
    NON_FEATURE_COLUMNS,
)
from cohortkit.functions.names import col
from cohortkit.functions.numeric import FLOATS, is_number, null_for_nan, present


# A sketch of 512 registers that estimates more than this has at least a tenth of
# it in use, each by a level of its own.
_SURE_LEVELS = 200


@dataclass
class SparseReport:
    dropped: list[str] = field(default_factory=list)
    kept_with_missing: list[str] = field(default_factory=list)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_missing, missing_ratio), one pass over the table."""
    columns = list(columns if columns is not None else df.columns)
    return missing_rows(df.agg(*present_counts(df, columns)), columns)


def present_counts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates for :func:`missing_rows`: rows, and present values of each column."""
    # The counts go by place, not by name: any column may be called anything.
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count(null_for_nan(col(c), types.get(c))).alias(f"c{i}") for i, c in enumerate(columns)],
    ]


def missing_rows(totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The one row of :func:`present_counts` as (column, n_rows, n_missing, missing_ratio)."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("present")) for i, c in enumerate(columns)
    ]
    long = totals.select("rows", F.explode(F.array(*entries)).alias("e"))
    absent = F.col("rows") - F.col("e.present")
    return long.select(
        F.col("e.column").alias("column"),
        F.col("rows").alias("n_rows"),
        absent.alias("n_missing"),
        F.try_divide(absent.cast("double"), F.col("rows").cast("double")).alias("missing_ratio"),
    )


def sparse_report(
    df: DataFrame, threshold: float = MISSING_THRESHOLD, columns: Sequence[str] | None = None
) -> SparseReport:
    """Columns missing in more than ``threshold`` of the rows, and kept ones with gaps."""
    report = SparseReport()
    for row in missing_counts(df, columns).collect():
        if row["missing_ratio"] is not None and row["missing_ratio"] > threshold:
            report.dropped.append(row["column"])
        elif row["n_missing"] > 0:
            report.kept_with_missing.append(row["column"])
    return report


def drop_sparse(
    df: DataFrame,
    threshold: float = MISSING_THRESHOLD,
    columns: Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
) -> tuple[DataFrame, SparseReport]:
    """Drop sparse columns; gaps in the others stay. ``fit_on`` measures elsewhere."""
    report = sparse_report(fit_on if fit_on is not None else df, threshold, columns)
    return df.drop(*report.dropped), report


def check_cleaned(df: DataFrame, label: str = LABEL, leakage: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    """The label must be there and no leakage column may be."""
    left = [c for c in leakage if c in df.columns]
    if left:
        raise RuntimeError(f"leakage columns survived cleaning: {left}")
    if label not in df.columns:
        raise RuntimeError(f"the '{label}' column was lost")
    return df


def short_level(text: Column) -> Column:
    """Long texts as their SHA-256, so that whole documents are not shuffled to be told apart."""
    digest = F.concat(F.lit("sha256:"), F.sha2(text, 256))
    return F.when(F.octet_length(text) > 71, digest).otherwise(text)


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_levels): exact distinct non-missing values of each column.

    Long form: each (column, value) pair is hashed to a task of its own, after
    duplicates were removed where they were read.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column STRING, n_levels LONG")
    # Adding zero makes -0.0 and 0.0 one level.
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOATS)}
    text = df.select(*[
        short_level((present(col(c)) + F.lit(0.0) if c in floats else col(c)).cast("string")).alias(f"c{i}")
        for i, c in enumerate(columns)
    ])
    names = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(f"c{i}"), F.lit(c))])
    pairs = text.unpivot([], text.columns, "slot", "value")
    counts = pairs.distinct().groupBy("slot").agg(F.count("value").alias("n_levels"))
    return counts.select(names[F.col("slot")].alias("column"), "n_levels")


def column_kinds(
    df: DataFrame, exclude: Sequence[str] = (), max_levels: int = MAX_CATEGORICAL_LEVELS
) -> DataFrame:
    """(column, n_levels, kind): text, or a number with few levels, is categorical."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numbers = [f.name for f in fields if is_number(f.dataType)]
    counts = level_counts(df, [f.name for f in fields])
    few = (F.col("n_levels") <= max_levels) | ~F.col("column").isin(numbers)
    return counts.withColumn("kind", F.when(few, "categorical").otherwise("numeric"))


def feature_kinds(
    df: DataFrame, exclude: Sequence[str] = (), max_levels: int = MAX_CATEGORICAL_LEVELS
) -> dict[str, list[str]]:
    """Column names by kind, in table order. Only numeric columns are scanned.

    Columns with clearly more levels are found by one sketch pass, so that their
    values need not be shuffled; the others are counted exactly.
    """
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numbers = [f.name for f in fields if is_number(f.dataType)]
    doubtful = numbers
    if numbers and max_levels <= _SURE_LEVELS // 10:
        row = df.agg(*[F.approx_count_distinct(col(c)).alias(f"c{i}") for i, c in enumerate(numbers)]).first()
        doubtful = [c for i, c in enumerate(numbers) if row[f"c{i}"] <= _SURE_LEVELS]
    few = {r["column"] for r in level_counts(df, doubtful).collect() if r["n_levels"] <= max_levels}
    numeric = [c for c in numbers if c not in few]
    return {"numeric": numeric, "categorical": [f.name for f in fields if f.name not in numeric]}


def feature_roles(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL_COLUMNS,
    exclude: Sequence[str] = NON_FEATURE_COLUMNS,
) -> tuple[list[str], list[str]]:
    """(categorical, numeric) feature names by name alone."""
    cats = [c for c in categorical if c in df.columns]
    skip = {*cats, *exclude, "split"}
    return cats, [c for c in df.columns if c not in skip]
