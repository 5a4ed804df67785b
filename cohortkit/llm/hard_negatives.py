"""Hard negatives by inner product, from STR-packed R-trees searched best first.

Rows of different (label, vector) are tiled by sort-tile-recursive slices into blocks that
fit a task; a task packs its block into an R-tree. The minimum bounding box of a node gives
for every component the interval of its product with an anchor's, and their sums bound the
scores of all rows below. Anchors pop their best boxes first and leave out boxes whose
interval misses the score window or lies strictly below the k-th row found.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortkit.llm.common import rows_of
from cohortkit.llm.hamming_topk import _smallest
from cohortkit.session import materialize

LEAF_ROWS = 64
FAN_OUT = 16
BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096
# Numbers of a block's vectors; wider vectors make blocks of fewer rows and queries.
BLOCK_CELLS = 1 << 20
# Slice edges of the tiles are those of so many rows (fewest hash first); every row is
# indexed, and larger tiles are split by hash.
SAMPLE_ROWS = 10_000
SLICES = 8
# Boxes a query pops at once.
POPS = 4
# Whole numbers below are exact as doubles.
EXACT = 2.0 ** 53


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
              label: Column | None = None, scale: int = 256) -> DataFrame:
    """(id, label, vec): floor(scale * component) of every row that has an id, a label and a
    vector of finite components only. ``label`` may replace the label (an expression over id and label)."""
    rows = rows_of(embeddings, id=id_col, label=label_col, vector=vector_col)
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL "
                      "AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(double(x)) = double('infinity'))")
    vec = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return rows.select(F.col("id").cast("bigint").alias("id"), (F.col("label") if label is None else label).cast("bigint").alias("label"), vec.alias("vec"))


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    most = lambda x: float(np.abs(x).max(initial=0))
    return a.shape[1] * most(a) * most(b) < EXACT


class RTree:
    """A static R-tree over the rows of one block (labels, vectors), packed by STR."""

    def __init__(self, labels: np.ndarray, vectors: np.ndarray):
        order = []
        for label in np.unique(labels):  # so that most leaves hold one label
            order.append(self._pack(vectors, np.flatnonzero(labels == label)))
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.labels, self.vectors = labels[self.order], vectors[self.order]
        # Levels from the leaves up; a node covers consecutive nodes of the level below.
        starts = np.arange(0, len(self.order), LEAF_ROWS)
        low, high = np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts)
        first, last = np.minimum.reduceat(self.labels, starts), np.maximum.reduceat(self.labels, starts)
        levels = [(low, high, first, last)]
        while len(levels[-1][0]) > 1:
            starts = np.arange(0, len(levels[-1][0]), FAN_OUT)
            levels.append(tuple(f.reduceat(x, starts) for f, x in zip((np.minimum, np.maximum, np.minimum, np.maximum), levels[-1])))
        # Nodes are numbered from the leaves up, so the last is the root.
        self.low, self.high, self.first, self.last = (np.concatenate([level[i] for level in levels]) for i in range(4))
        sizes = [len(level[0]) for level in levels]
        self.leaves, offsets = sizes[0], np.cumsum([0, *sizes])
        self.parent = np.full(offsets[-1], -1)
        for n, size in enumerate(sizes[:-1]):
            self.parent[offsets[n]:offsets[n] + size] = offsets[n + 1] + np.arange(size) // FAN_OUT
        self.children = [np.flatnonzero(self.parent == node) for node in range(offsets[-1])]

    @staticmethod
    def _pack(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sort-tile-recursive order: slabs of equal size along one component after the
        other, those that vary most first, until a slab is a leaf."""
        n_leaves = -(-len(rows) // LEAF_ROWS)
        by_spread = np.argsort(-vectors[rows].std(0), kind="stable") if len(rows) else []
        depth = min(len(by_spread), max(1, math.ceil(math.log2(max(2, n_leaves)))))

        def tile(rows, level):
            leaves = -(-len(rows) // LEAF_ROWS)
            if leaves <= 1 or level == depth:
                return [rows]
            rows = rows[np.argsort(vectors[rows, by_spread[level]], kind="stable")]
            slabs = math.ceil(leaves ** (1 / (depth - level)))
            step = LEAF_ROWS * -(-leaves // slabs)
            return [part for at in range(0, len(rows), step) for part in tile(rows[at:at + step], level + 1)]

        return np.concatenate(tile(rows, 0)) if len(rows) else rows

    def search(self, queries: np.ndarray, own: np.ndarray, same: bool, low: list, high: list, k: int, first_ids: np.ndarray):
        """(query, row, score) of each query's best k rows by (score, smaller first id).

        Rows of the query's label (``same``) or of all others, with low <= score <= high
        (None: no limit).
        """
        if not len(queries) or not len(self.order):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        exact = _exact(self.vectors, queries)
        kind = np.float64 if exact else object  # beyond 53 bits Python's whole numbers
        whole = (lambda x: x) if exact else lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
        vectors, asked = whole(self.vectors), whole(queries)
        low = np.array([-math.inf if v is None else v for v in low], kind)
        high = np.array([math.inf if v is None else v for v in high], kind)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        # Where doubles round, the boxes are widened by more than the error.
        slack = 0.0 if exact else 1e-9 * (np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T + 1)
        top = up @ self.high.T + down @ self.low.T + slack
        bottom = up @ self.low.T + down @ self.high.T - slack
        if same:
            fits = (self.first <= own[:, None]) & (own[:, None] <= self.last)
        else:
            fits = (self.first != own[:, None]) | (self.last != own[:, None])
        fits &= (top >= low[:, None]).astype(bool) & (bottom <= high[:, None]).astype(bool)
        top = np.where(fits, top, -np.inf)
        queue = np.full(top.shape, -np.inf)
        root = top.shape[1] - 1
        queue[:, root] = top[:, root]
        kth = np.full(len(queries), -np.inf)
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)]
        ids = first_ids[self.order]
        active = np.flatnonzero(queue[:, root] > -np.inf)
        while len(active):
            some = queue[active]
            pops = min(POPS, some.shape[1])
            popped = np.argpartition(-some, pops - 1, axis=1)[:, :pops]
            bound = np.take_along_axis(some, popped, 1)
            use = (bound > -np.inf) & (bound >= kth[active][:, None])  # strictly below the k-th: pruned
            queue[active[:, None], popped] = -np.inf
            q, node = np.repeat(active, pops)[use.ravel()], popped[use]
            inner = node >= self.leaves
            for at in np.unique(node[inner]):
                where = np.ix_(q[node == at], self.children[at])
                queue[where] = top[where]
            found = [[], [], []]
            for at in np.unique(node[~inner]):
                who = q[node == at]
                rows = slice(at * LEAF_ROWS, min((at + 1) * LEAF_ROWS, len(self.order)))
                scores = asked[who] @ vectors[rows].T
                near = (scores >= np.maximum(low, kth)[who][:, None]) & (scores <= high[who][:, None])
                x, y = np.nonzero(near.astype(bool) & ((self.labels[rows] == own[who][:, None]) == same))
                for out, values in zip(found, (who[x], y + at * LEAF_ROWS, scores[x, y])):
                    out.append(values)
            if any(map(len, found[0])):
                best = [np.concatenate([old, *new]) for old, new in zip(best, found)]
                order = np.lexsort((ids[best[1]], -best[2], best[0])) if exact else np.array(
                    sorted(range(len(best[0])), key=lambda i: (best[0][i], -best[2][i], ids[best[1][i]])), np.int64)
                best = [x[order] for x in best]
                rank = np.arange(len(order)) - np.searchsorted(best[0], best[0])
                best, rank = [x[rank < k] for x in best], rank[rank < k]
                kth[best[0][rank == k - 1]] = best[2][rank == k - 1].astype(np.float64)
            active = active[((queue[active] > -np.inf) & (queue[active] >= kth[active][:, None])).any(1)]
        return best[0], self.order[best[1]], best[2]


def _search(same: bool, k: int):
    columns = ["query", "score", "id", "entry"]

    def run(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
        width = max(1, *map(len, [*block["vec"], *queries["vec"]]))
        ids = [np.asarray(x, np.int64) for x in block["ids"]]
        tree = RTree(block["label"].to_numpy(np.int64), _matrix(block["vec"], width))
        low, high = ([None if pd.isna(v) else int(v) for v in queries[c].astype(object)] for c in ("low", "high"))
        q, row, score = tree.search(_matrix(queries["vec"], width), queries["label"].to_numpy(np.int64), same, low, high, k,
                                    np.array([x[0] for x in ids]))
        held = np.array([len(x) for x in ids], np.int64)[row]
        found = np.concatenate([ids[r] for r in row]) if len(row) else np.zeros(0, np.int64)
        limits = np.iinfo(np.int64)
        score = np.array([min(max(int(s), limits.min), limits.max) for s in score], np.int64)
        q, score, entry = (np.repeat(x, held) for x in (q, score, block["entry"].to_numpy(np.int64)[row]))
        order = np.lexsort((found, -score, q))
        q, score, found, entry = q[order], score[order], found[order], entry[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return pd.DataFrame(dict(zip(columns, (queries["query"].to_numpy()[q[kept]], score[kept], found[kept], entry[kept]))))

    return run


def tiles(entries: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """``entries`` with the number of its block, and how many blocks there are.

    Sort-tile-recursive over all rows: slices along the component that varies most, in
    each slice along the next, and so on. The edges are quantiles of SAMPLE_ROWS rows; they
    only decide which rows lie together. A tile that holds more than a block (equal
    components, edges off) is split by a hash of the row.
    """
    n = entries.count()
    n_blocks = max(1, -(-n // block_rows))
    if n_blocks == 1:
        return entries.withColumn("x", F.lit(0)), 1
    sample = entries.where(F.pmod("entry", F.lit(n)) < SAMPLE_ROWS).select("vec").toPandas()["vec"]
    vectors = _matrix(sample, max(map(len, sample), default=0))
    depth = min(math.ceil(math.log(n_blocks, SLICES)), vectors.shape[1])
    slices = math.ceil(n_blocks ** (1 / depth)) if depth else 1
    tile, places = F.lit(0), np.zeros(len(vectors), np.int64)
    for level, axis in enumerate(np.argsort(-vectors.std(0), kind="stable")[:depth]):
        edges = []
        for place in range(slices ** level):
            inside = np.sort(vectors[places == place, axis])
            edges.append([float(inside[len(inside) * i // slices]) if len(inside) else 0.0 for i in range(1, slices)])
        places = places * slices + np.array([np.searchsorted(edges[p], v, side="right") for p, v in zip(places, vectors[:, axis])], np.int64)
        value = F.coalesce(F.get("vec", F.lit(int(axis))), F.lit(0)).cast("double")
        own = F.get(F.array(*[F.array(*map(F.lit, e)) for e in edges]), tile)
        tile = tile * slices + F.size(F.filter(own, lambda e, v=value: e <= v))
    dealt = entries.withColumn("tile", tile.cast("int"))
    # One row a tile, n / block_rows in all.
    sizes = sorted((r["tile"], -(-r["count"] // block_rows)) for r in dealt.groupBy("tile").count().collect())
    starts = np.cumsum([0] + [parts for _, parts in sizes]).tolist()
    blocks = entries.sparkSession.createDataFrame(
        [(t, start, parts) for (t, parts), start in zip(sizes, starts)], "tile int, start int, parts int")
    dealt = dealt.join(F.broadcast(blocks), "tile")
    return dealt.withColumn("x", F.expr("start + CAST(pmod(entry, parts) AS INT)")).drop("tile", "start", "parts"), starts[-1]


def _best(blocks: DataFrame, n_blocks: int, queries: DataFrame, same: bool, k: int, block_queries: int) -> DataFrame:
    """(query, score, id, entry): the k best rows of each query (query, label, vec, low, high)."""
    n_queries = max(1, -(-queries.count() // block_queries))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.withColumn("y", every(n_queries))
    right = queries.withColumn("y", F.pmod("query", F.lit(n_queries)).cast("int")).withColumn("x", every(n_blocks))
    # Few but costly groups: as many tasks, whatever their bytes.
    left, right = (side.repartition(4 * n_blocks * n_queries, "x", "y") for side in (left, right))
    found = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInPandas(
        _search(same, k), "query bigint, score bigint, id bigint, entry bigint")
    down = found.select("query", (-F.col("score")).alias("down"), "id", "entry")
    return materialize(_smallest(down, ["query"], k).select("query", (-F.col("down")).alias("score"), "id", "entry"))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low_percent: int = 30,
                   high_percent: int = 90, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    ``rows``: id, label, vec (whole numbers). A score is the inner product with the anchor;
    higher first, ties by smaller id. An anchor's positives are its first other rows of the
    same label; of each, the negatives are the first rows of other labels with
    low_percent * positive <= 100 * score <= high_percent * positive.

    Repeated (id, label, vec) rows count once; rows that share an id only are rows of their
    own. Of vectors of different lengths the missing components are zero; scores beyond 64
    bits are set to the end of the range. An anchor without a positive, a window without a
    row and an empty table give no rows.

    Rows of equal label and vector are searched once and keep only their first ids (no more
    can be returned), so a vector that a third of the rows share is one entry; anchors of
    equal label and vector, and equal windows, are one query. Every block of entries meets
    every block of queries: queries x entries / block size rows are moved.
    """
    entry = F.xxhash64("label", "vec").alias("entry")
    rows = materialize(rows.select("id", "label", "vec", entry).distinct())
    firsts = _smallest(rows, ["label", "vec", "entry"], max(positives + 1, negatives))
    entries = materialize(firsts.groupBy("label", "vec", "entry").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    width = max(1, entries.agg(F.max(F.size("vec"))).first()[0] or 0)
    block_rows, block_queries = (max(LEAF_ROWS, min(n, BLOCK_CELLS // width)) for n in (block_rows, block_queries))
    blocks, n_blocks = tiles(entries, block_rows)
    anchors = materialize(rows.where(is_anchor).withColumnsRenamed({"id": "anchor_id", "entry": "query"}))
    none = F.lit(None).cast("bigint")
    asked = anchors.select("query", "label", "vec").distinct().withColumns({"low": none, "high": none})
    near = _best(blocks, n_blocks, asked, True, positives + 1, block_queries)
    pairs = anchors.join(near, "query").where("NOT (id = anchor_id AND entry = query)")
    first = Window.partitionBy("anchor_id", "query").orderBy(F.desc("score"), "id", "entry")
    pairs = pairs.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives)
    pairs = materialize(pairs.select(
        "anchor_id", F.col("query").alias("anchor"), "label", "vec", F.col("id").alias("positive_id"), F.col("entry").alias("positive"),
        F.col("score").alias("positive_score"), F.xxhash64("label", "vec", "score").alias("query")))
    limits = {"low": F.expr(f"CAST(ceil(positive_score * {low_percent}BD / 100BD) AS BIGINT)"),
              "high": F.expr(f"CAST(floor(positive_score * {high_percent}BD / 100BD) AS BIGINT)")}
    windows = pairs.withColumns(limits).where("low <= high").select("query", "label", "vec", "low", "high").distinct()
    out = pairs.join(_best(blocks, n_blocks, windows, False, negatives, block_queries), "query")
    first = Window.partitionBy("anchor_id", "anchor", "positive_id", "positive").orderBy(F.desc("score"), "id", "entry")
    return out.select("anchor_id", "positive_id", F.row_number().over(first).alias("rank"), F.col("id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))
