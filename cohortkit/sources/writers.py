"""Results out: every writer is one distributed write, never one file by force."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortkit.functions.names import col
from cohortkit.operators.fingerprint import table_fingerprint
from cohortkit.sources.published import replace_folder


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table; folders are made as needed and no row index is added.

    A table that is overwritten stays as it was until the new one is there.
    """
    writer = df.write if mode == "overwrite" else df.write.mode(mode)
    write = writer.option("header", True).csv if fmt == "csv" else writer.parquet
    if mode == "overwrite":
        replace_folder(df.sparkSession, path, write)
    else:
        write(path)


def _write_protocol(df: DataFrame, path: str, protocol: str, fmt: str) -> None:
    # The protocol's whole folder is replaced: a split that the new rows do not have goes.
    writer = df.write.partitionBy("split")
    write = writer.option("header", True).csv if fmt == "csv" else writer.parquet
    replace_folder(df.sparkSession, f"{path.rstrip('/')}/protocol={protocol}", write)


def write_packs(packs: DataFrame, path: str, protocol: str, fmt: str = "parquet") -> None:
    """All splits of a protocol in one write, a folder per protocol and split."""
    _write_protocol(packs, path, protocol, fmt)


def write_membership(
    rows: DataFrame, path: str, protocol: str, key: str = "patient_id", fmt: str = "parquet"
) -> None:
    """Which key went to which split; an empty split leaves no folder."""
    _write_protocol(rows.select(col(key), "split"), path, protocol, fmt)


def write_predictions(
    predictions: DataFrame, path: str, protocol: str, version: str, fmt: str = "parquet"
) -> None:
    """Scored rows, a folder per protocol and version; only this version's is replaced."""
    write_table(predictions, f"{path.rstrip('/')}/protocol={protocol}/version={version}", fmt)


def feature_catalog(df: DataFrame, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per feature with its kind and the number of features."""
    named = [(name, kind) for kind, names in kinds.items() for name in names]
    rows = df.sparkSession.createDataFrame(named, "feature STRING, kind STRING")
    return rows.withColumn("total_features", F.lit(len(named)))


def write_feature_catalog(df: DataFrame, path: str, kinds: Mapping[str, Sequence[str]]) -> None:
    feature_catalog(df, kinds).withColumn("generated_at", F.current_timestamp()).write.mode(
        "overwrite"
    ).json(path)


def manifest(df: DataFrame, config: Mapping | None = None, portable: bool = False) -> DataFrame:
    """One row that identifies a version of a table: shape, schema, content hash."""
    return table_fingerprint(df, portable).select(
        F.col("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(json.dumps(df.columns)).alias("columns"),
        F.lit(json.dumps(dict(df.dtypes))).alias("dtypes"),
        F.col("fingerprint").alias("data_hash"),
        F.lit(json.dumps(dict(config or {}), sort_keys=True, default=str)).alias("config"),
    )


def append_manifest(df: DataFrame, path: str, config: Mapping | None = None) -> None:
    """Add the table's record to the version log."""
    manifest(df, config).withColumn("recorded_at", F.current_timestamp()).write.mode("append").json(path)


def metrics_summary(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Test metrics per protocol, a column per stage and metric.

    ``metrics`` is long: (protocol, split, stage, metric, value).
    """
    stages = ("before_calibration", "after_calibration")
    wanted = [f"{s}_{m}" for s in stages for m in names]
    tests = metrics.where(F.col("split") == "test")
    labelled = tests.withColumn("slot", F.concat_ws("_", "stage", "metric"))
    return labelled.groupBy("protocol").pivot("slot", wanted).agg(F.first("value"))
