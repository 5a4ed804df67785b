"""A bitmap of key hashes that keeps most foreign rows out of a shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.functions.names import col
from cohortkit.operators.sizing import measured_small
from cohortkit.session import materialize

# The bitmap lies in chunks; a key sets PROBES bits of one chunk.
CHUNK_BITS = 4096
PROBES = 3
BITS_PER_KEY = 16
# What is broadcast never grows beyond this.
FILTER_BYTES = 32 * 1024 * 1024


def _places(key: Column, n_chunks: int) -> tuple[Column, list[Column]]:
    """The chunk of a key, and the places of its bits there."""
    bits = F.xxhash64(key, F.lit(1))
    shifts = [bits if not i else F.shiftrightunsigned(bits, 12 * i) for i in range(PROBES)]
    return F.pmod(F.xxhash64(key), F.lit(n_chunks)), [s.bitwiseAND(F.lit(CHUNK_BITS - 1)).cast("int") for s in shifts]


def key_bitmap(keys: DataFrame, key: str, n_keys: int, bits_per_key: int = BITS_PER_KEY, max_bytes: int = FILTER_BYTES) -> tuple[DataFrame, int] | None:
    """((chunk, words), number of chunks) of the keys' bitmap, or None if it would take more
    than ``max_bytes`` at a quarter of ``bits_per_key``.

    Equal bits are merged before they are shuffled. About one foreign key in 200 passes
    at 16 bits a key.
    """
    least = n_keys * bits_per_key // 4 // 8
    if least > max_bytes:
        return None
    n_chunks = max(1, math.ceil(min(n_keys * bits_per_key, max_bytes * 8) / CHUNK_BITS))
    chunk, places = _places(col(key), n_chunks)
    bits = keys.where(col(key).isNotNull()).select(chunk.alias("chunk"), F.explode(F.array(*places)).alias("place"))
    word, bit = (F.col("place") / 64).cast("int"), F.expr("shiftleft(1L, place % 64)")
    words = bits.groupBy("chunk", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    held = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    every = F.expr(f"transform(sequence(0, {CHUNK_BITS // 64 - 1}), i -> coalesce(held[i], 0L))")
    chunks = words.groupBy("chunk").agg(held.alias("held")).select("chunk", every.alias("words"))
    return materialize(chunks), n_chunks


def keep_possible(df: DataFrame, key: str, bitmap: tuple[DataFrame, int] | None, like: DataFrame | None = None) -> DataFrame:
    """Rows whose key may be in the bitmap: all rows of its keys, and few others.

    ``like`` is the table of the keys, whose type the key is given. The bitmap is broadcast
    (its size has a bound) and tested in the scan's own stage; without one all rows stay.
    """
    if bitmap is None:
        return df
    chunks, n_chunks = bitmap
    value = col(key) if like is None else col(key).cast(like.schema[key].dataType)
    chunk, places = _places(value, n_chunks)
    words = chunks.select(F.col("chunk").alias("__chunk"), F.col("words").alias("__words"))
    held = [F.expr("1") == F.getbit(F.get("__words", (p / 64).cast("int")), p % 64).cast("int") for p in places]
    test = chunk == F.col("__chunk")
    for h in held:
        test = test & h
    return df.join(F.broadcast(words), test, "left_semi")


def within_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys`` (a written table of different keys).

    Small keys are broadcast. Otherwise a bitmap keeps most foreign rows out of the
    shuffle, and the exact semi join decides about the rest.
    """
    if measured_small(keys):
        return df.join(F.broadcast(keys), key, "left_semi")
    return keep_possible(df, key, key_bitmap(keys, key, keys.count()), keys).join(keys, key, "left_semi")
