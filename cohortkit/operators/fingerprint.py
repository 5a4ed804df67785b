"""A content hash of a table that does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.functions.names import col


def _fast_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two differently seeded 64-bit hashes of a row.

    The place of every column is mixed in, because a plain row hash skips missing
    values and would not see which column they are in.
    """
    placed = [part for i, c in enumerate(df.columns) for part in (F.lit(i), col(c))]
    return F.xxhash64(F.lit("a"), *placed), F.xxhash64(F.lit("b"), *placed)


def _portable_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 60-bit parts of the MD5 of the row as text: any engine can repeat them."""

    def shown(c: str) -> Column:
        text = col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = F.md5(F.concat_ws("|", *[shown(c) for c in df.columns]))
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16))


def table_fingerprint(df: DataFrame, portable: bool = False) -> DataFrame:
    """(n_rows, hash_xor, hash_sum, fingerprint) over all rows, in one pass.

    Hashes are summed besides being combined by XOR, under which equal rows cancel
    out. ``portable`` costs more and uses only MD5 of text.
    """
    first, second = _portable_hashes(df) if portable else _fast_hashes(df)

    def total(h: Column) -> Column:
        zero = F.lit(0).cast("decimal(38,0)")
        return F.coalesce(F.sum(h.cast("decimal(28,0)")), zero).cast("decimal(38,0)").cast("string")

    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bit_xor(first), F.lit(0).cast("long")).alias("hash_xor"),
        total(first).alias("hash_sum"),
        total(second).alias("hash_sum2"),
    )
    schema = F.lit(",".join(f"{n}:{t}" for n, t in df.dtypes))
    text = F.concat_ws("|", schema, "n_rows", "hash_xor", "hash_sum", "hash_sum2")
    return totals.withColumn("fingerprint", F.sha2(text, 256)).drop("hash_sum2")
