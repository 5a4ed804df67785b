"""Keys that must name one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortkit.functions.names import col
from cohortkit.operators.sizing import small_side
from cohortkit.session import materialize

# Repeated keys that an error names.
_NAMED = 20


def _hashed(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Present keys with their hash, and the hashes that several rows have."""
    hashed = df.where(col(key).isNotNull()).select(col(key), F.xxhash64(col(key)).alias("__hash"))
    again = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__hash")
    return hashed, again


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of every present key that several rows have.

    First only 8 bytes of hash a row are grouped (a key with very many rows is one row of a task);
    whole keys are compared only where a hash occurs again.
    """
    hashed, again = _hashed(df, key)
    near = hashed.join(small_side(materialize(again)), "__hash", "left_semi")
    return near.groupBy(col(key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise, naming keys, when a key occurs more than once. Missing keys are left to others."""
    if _hashed(df, key)[1].isEmpty():
        return
    # The 21 smallest are enough to name 20.
    found = repeated_keys(df, key).orderBy(col(key)).limit(_NAMED + 1).collect()
    if found:
        names = ", ".join(f"{r[0]} ({r[1]} rows)" for r in found[:_NAMED])
        raise ValueError(f"'{key}' must be unique: {names}" + (", ..." if len(found) > _NAMED else ""))
