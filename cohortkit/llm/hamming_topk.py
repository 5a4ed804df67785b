"""Exact nearest neighbours of 64-bit codes, by incremental multi-index hashing."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortkit.llm.common import rows_of
from cohortkit.session import materialize

BITS = 64
BLOCK_CODES = 16_384
BLOCK_QUERIES = 4096


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bit i is set if element i (of the first 64) is zero or more. Missing
    elements count as negative; rows with a NULL id or vector have no code."""
    rows = rows_of(vectors, id=id_col, vector=vector_col).where("id IS NOT NULL AND vector IS NOT NULL")
    code = F.expr(f"aggregate(transform(slice(vector, 1, {BITS}), (x, i) -> IF(coalesce(x >= 0, false), shiftleft(1L, i), 0L)), "
                  "0L, (a, b) -> a | b)")
    return rows.select(F.col("id").cast("bigint").alias("id"), code.alias("code"))


def _smallest(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k rows of each key that come first by the other columns, in two steps, so that
    a key with very many rows is cut down before its rows meet."""
    order = [c for c in rows.columns if c not in keys]
    salt = F.pmod(F.xxhash64(*order), F.lit(64))
    first = Window.partitionBy(*keys, "salt").orderBy(*order)
    rows = rows.withColumn("salt", salt).withColumn("n", F.row_number().over(first)).where(F.col("n") <= k)
    then = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("n", F.row_number().over(then)).where(F.col("n") <= k).drop("salt", "n")


class MultiIndex:
    """Tables of one block of different codes, one for each segment of their bits."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        width = min(16, max(4, round(math.log2(max(2, len(codes))))))
        self.segments = -(-BITS // width)
        edges = [round(i * BITS / self.segments) for i in range(self.segments + 1)]
        self.cuts = [(a, b - a) for a, b in itertools.pairwise(edges)]
        self.tables = []
        for segment in range(self.segments):
            keys = self.keys(codes, segment)
            order = np.argsort(keys, kind="stable")
            ends = np.cumsum(np.bincount(keys, minlength=1 << self.cuts[segment][1]))
            self.tables.append((order, np.concatenate(([0], ends))))

    def keys(self, codes: np.ndarray, segment: int) -> np.ndarray:
        shift, width = self.cuts[segment]
        return (codes >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)

    def within(self, queries: np.ndarray, radius: int):
        """(query, code, distance) places, in batches, of the codes that differ from a query
        in exactly ``radius`` bits of some segment and that no smaller radius finds; each
        pair comes once, from the first segment that has it."""
        for segment, (order, offsets) in enumerate(self.tables):
            width = self.cuts[segment][1]
            if radius > width:
                continue
            masks = np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(width), radius)], np.int64)
            keys = self.keys(queries, segment)
            step = max(1, 500_000 // len(masks))
            for at in range(0, len(queries), step):
                some = keys[at:at + step, None] ^ masks
                first, n = offsets[some].ravel(), (offsets[some + 1] - offsets[some]).ravel()
                place = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                query = np.repeat(np.repeat(np.arange(len(some)) + at, len(masks)), n)
                code = order[place]
                apart = queries[query] ^ self.codes[code]
                new = np.ones(len(code), bool)
                for other, (shift, bits) in enumerate(self.cuts):
                    if other != segment:
                        far = np.bitwise_count(apart & np.uint64((1 << bits) - 1 << shift))
                        new &= far > radius if other < segment else far >= radius
                yield query[new], code[new], np.bitwise_count(apart[new]).astype(np.int64)


def nearest(index: MultiIndex, held: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, code, distance) of all codes up to each query's k-th distance, where a code
    counts ``held`` times.

    All segments are searched at radius 0, 1, ... After radius r every code within
    segments * (r + 1) - 1 bits has been seen, since some segment differs in r bits or
    less; a query is done when its k-th verified distance is covered. When a shell has
    more keys than the block has codes, the rest is verified against every code.
    """
    seen = np.zeros((len(queries), BITS + 1), np.int64)  # codes by distance
    kth = np.full(len(queries), BITS)
    pairs = [np.zeros(0, np.int64)] * 3
    active = np.arange(len(queries))
    out = []

    def add(q, c, far):
        np.add.at(seen, (q, far), held[c])
        enough = seen[active].cumsum(1) >= k
        kth[active] = np.where(enough[:, -1], enough.argmax(1), BITS)

    for radius in itertools.count():
        if not len(active):
            break
        widest = max(width for _, width in index.cuts)
        if radius > widest or index.segments * math.comb(widest, radius) > len(index.codes):
            seen[active] = 0
            every, step = active, max(1, 2_000_000 // len(index.codes))
            for at in range(0, len(every), step):
                active = every[at:at + step]
                far = np.bitwise_count(queries[active][:, None] ^ index.codes[None, :]).astype(np.int64)
                q, c = np.repeat(active, len(index.codes)), np.tile(np.arange(len(index.codes)), len(active))
                add(q, c, far.ravel())
                near = far.ravel() <= kth[q]
                out.append((q[near], c[near], far.ravel()[near]))
            break
        found = [pairs]
        for q, c, far in index.within(queries[active], radius):
            q = active[q]
            near = far <= kth[q]
            found.append([q[near], c[near], far[near]])
        new = [np.concatenate([f[i] for f in found[1:]]) if found[1:] else pairs[0][:0] for i in range(3)]
        add(*new)
        pairs = [np.concatenate((old, x)) for old, x in zip(pairs, new)]
        near = pairs[2] <= kth[pairs[0]]
        pairs = [x[near] for x in pairs]
        done = (kth <= index.segments * (radius + 1) - 1) & (seen.sum(1) >= k)
        ready = done[pairs[0]]
        out.append(tuple(x[ready] for x in pairs))
        pairs = [x[~ready] for x in pairs]
        active = active[~done[active]]
    return tuple(np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(3))


def _search(k: int):
    columns = ["query_code", "distance", "id"]

    def run(codes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(codes) or not len(queries):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
        values = codes["code"].to_numpy(np.int64).view(np.uint64)
        ids = [np.asarray(x, np.int64) for x in codes["ids"]]
        held = np.array([len(x) for x in ids], np.int64)
        asked = queries["code"].to_numpy(np.int64)
        q, c, far = nearest(MultiIndex(values), held, asked.view(np.uint64), min(k, int(held.sum())))
        first = np.cumsum(held) - held
        n = held[c]
        place = np.repeat(first[c], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        q, far, found = np.repeat(q, n), np.repeat(far, n), np.concatenate(ids)[place]
        order = np.lexsort((found, far, q))
        q, far, found = q[order], far[order], found[order]
        start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.concatenate((start, [len(q)]))))
        kept = rank < k
        return pd.DataFrame(dict(zip(columns, (asked[q[kept]], far[kept], found[kept]))))

    return run


def top_k(codes: DataFrame, is_query: Column, k: int = 10, block_codes: int = BLOCK_CODES, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, id, distance): for each row of ``codes`` (id, code) that is a
    query, its k nearest other rows by (Hamming distance, id), exactly.

    Equal codes are searched once and keep only their k + 1 smallest ids, so a code that
    a third of the rows share costs one entry. Repeated (id, code) rows count once; fewer
    than k other rows give fewer; an empty table or no query gives none.

    The different codes are dealt to blocks that fit a task, the queries' codes to blocks
    as well, and each pair of blocks is searched by itself (queries x codes / block size
    rows are moved). A pair returns at most k + 1 rows a query code.
    """
    rows = materialize(codes.select("id", "code").where("id IS NOT NULL AND code IS NOT NULL").distinct())
    entries = materialize(_smallest(rows, ["code"], k + 1).groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    queries = rows.where(is_query)
    asked = materialize(queries.select("code").distinct())
    n_codes = max(1, -(-entries.count() // block_codes))
    n_queries = max(1, -(-asked.count() // block_queries))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")
    left = entries.select("code", "ids", dealt(n_codes).alias("x"), every(n_queries).alias("y"))
    right = asked.select("code", dealt(n_queries).alias("y"), every(n_codes).alias("x"))
    # Few but costly groups: as many tasks, whatever their bytes.
    left, right = (side.repartition(4 * n_codes * n_queries, "x", "y") for side in (left, right))
    found = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInPandas(_search(k + 1), "query_code bigint, distance bigint, id bigint")
    best = materialize(_smallest(found, ["query_code"], k + 1))
    each = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query_code")).join(best, "query_code").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_code").orderBy("distance", "id"))
    return each.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
