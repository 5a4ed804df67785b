"""Ranked lexical search for many items at once, by shared partial scores.

Term sets that items share are mined and become nodes of a graph: a node is a set of terms
that occur in the same items, or the union of two nodes that several items hold. For every
document each node's score is added up once, and an item's score is the sum of few nodes.
"""

from __future__ import annotations

import heapq
import pickle
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortkit.llm.common import release_memory, rows_of
from cohortkit.llm.hamming_topk import _smallest
from cohortkit.operators.running import running_totals
from cohortkit.session import materialize

# Items are planned in blocks of about so many (item, term) pairs.
BLOCK_TERMS = 16_384
# Plans of one pass over the documents; more blocks take more passes.
PLAN_BYTES = 32 * 1024 * 1024
# Of an item's term sets only so many, those in most items first, may be joined further.
PAIR_SETS = 64
# Numbers a task holds for a batch of documents.
BATCH_CELLS = 4_000_000

# A term is a run of ASCII letters and digits and of characters beyond ASCII; A-Z become a-z.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_BYTES).split()


class Plan:
    """The graph of a block of items.

    ``terms`` and the term set ``set_of`` each belongs to; ``joins`` (level by level: numbers
    of the two nodes each new node joins; nodes are numbered on from the term sets);
    ``nodes`` of each item of ``ids``, one list after the other, from ``starts`` on.
    """

    def __init__(self, items: dict):
        self.ids = list(items)
        holders = defaultdict(list)
        for item, terms in enumerate(items.values()):
            for term in set(terms):
                holders[term].append(item)
        sets: dict[tuple, int] = {}
        self.terms = sorted(holders)
        self.set_of = np.array([sets.setdefault(tuple(holders[t]), len(sets)) for t in self.terms], np.int64)
        self.n_sets = len(sets)
        has = [set() for _ in self.ids]
        for members, number in sets.items():
            for item in members:
                has[item].add(number)
        joins = self._join(has, {n: len(m) for m, n in sets.items()})
        depth, levels = {}, defaultdict(list)
        for number, (a, b) in enumerate(joins, self.n_sets):
            depth[number] = 1 + max(depth.get(a, 0), depth.get(b, 0))
            levels[depth[number]].append((number, a, b))
        self.joins = [np.array(levels[d], np.int64).T for d in sorted(levels)]
        self.n_nodes = self.n_sets + len(joins)
        self.starts = np.cumsum([0, *map(len, has)])[:-1]
        self.nodes = np.array([n for some in has for n in sorted(some)], np.int64)

    def dump(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def load(cls, data: bytes) -> Plan:
        plan = cls.__new__(cls)
        vars(plan).update(pickle.loads(data))
        return plan

    @staticmethod
    def _join(has: list[set], holders: dict[int, int]) -> list[tuple[int, int]]:
        """Replace the pair of nodes that most items hold by a new node, until no pair has two."""
        open_ = [set(sorted((n for n in some if holders[n] > 1), key=lambda n: (-holders[n], n))[:PAIR_SETS]) for some in has]
        pairs = defaultdict(set)
        for item, some in enumerate(open_):
            ordered = sorted(some)
            for i, a in enumerate(ordered):
                for b in ordered[i + 1:]:
                    pairs[a, b].add(item)
        heap = [(-len(items), pair) for pair, items in pairs.items() if len(items) > 1]
        heapq.heapify(heap)
        joins, new = [], len(holders)
        while heap:
            count, (a, b) = heapq.heappop(heap)
            items = {i for i in pairs.pop((a, b), ()) if a in open_[i] and b in open_[i]}
            if len(items) != -count:
                if len(items) > 1:
                    pairs[a, b] = items
                    heapq.heappush(heap, (-len(items), (a, b)))
                continue
            joins.append((a, b))
            grown = defaultdict(set)
            for item in items:
                for some in (has[item], open_[item]):
                    some -= {a, b}
                for other in open_[item]:
                    grown[other, new].add(item)
                has[item].add(new)
                open_[item].add(new)
            for pair, some in grown.items():
                if len(some) > 1:
                    pairs[pair] = some
                    heapq.heappush(heap, (-len(some), pair))
            new += 1
        return joins

    def scores(self, parts: np.ndarray) -> np.ndarray:
        """(item, document) sums from (term, document) parts."""
        order = np.argsort(self.set_of, kind="stable")
        first = np.searchsorted(self.set_of[order], np.arange(self.n_sets))
        nodes = np.empty((self.n_nodes, parts.shape[1]), np.int64)
        nodes[:self.n_sets] = np.add.reduceat(parts[order], first, axis=0)
        for number, a, b in self.joins:
            nodes[number] = nodes[a] + nodes[b]
        return np.add.reduceat(nodes[self.nodes], self.starts, axis=0)


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    items = defaultdict(list)
    for number, term in zip(rows["item"], rows["term"]):
        items[number].append(bytes(term))
    plan = Plan(dict(sorted(items.items())))
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "plan": [plan.dump()]})


class _Best:
    """The best ``top`` documents of each item so far, by (score, smaller id); a NULL id is the smallest."""

    def __init__(self, plan: Plan, top: int):
        self.plan, self.top = plan, top
        self.least = np.ones(len(plan.ids), np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, has an id, id

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray):
        item, doc = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        new = (item, scores[item, doc], known[doc], ids[doc])
        rows = [np.concatenate(x) for x in zip(self.rows, new)]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        rank = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.rows = [x[rank < self.top] for x in rows]
        last = rank == self.top - 1
        self.least[rows[0][last]] = rows[1][last]


def _postings(vocabulary):
    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            sizes, lengths, found, times = [], [], [], []
            for text in batch["text"]:
                words = terms_of(text.as_py())
                n = 0
                for term, times_ in Counter(words).items():
                    place = number.get(term)
                    if place is not None:
                        found.append(place)
                        times.append(times_)
                        n += 1
                sizes.append(n)
                lengths.append(len(words))
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))], ["doc_id", "n", "terms", "times"])
        release_memory()

    return run


def _rank(shared, n_docs: int, n_terms: int, top: int):
    def run(batches):
        plans, vocabulary, weights = shared.value
        number = {t: i for i, t in enumerate(vocabulary)}
        blocks = []
        for data in plans:
            plan = Plan.load(data)
            place = np.full(len(vocabulary), -1)
            place[[number[t] for t in plan.terms]] = np.arange(len(plan.terms))
            blocks.append((plan, place, _Best(plan, top), max(1, BATCH_CELLS // (len(plan.terms) + plan.n_nodes + len(plan.nodes)))))
        for batch in batches:
            ends = batch["terms"].offsets.to_numpy().astype(np.int64)
            terms, times = (batch[c].values.to_numpy().astype(np.int64) for c in ("terms", "times"))
            n = batch["n"].to_numpy()
            known = batch["doc_id"].is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch["doc_id"].fill_null(0).to_numpy()
            doc = np.repeat(np.arange(len(n)), np.diff(ends))
            terms, times = terms[ends[0]:ends[-1]], times[ends[0]:ends[-1]]
            room = 50 + (50 * n * n_docs) // n_terms
            value = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * room[doc]))
            ends = ends - ends[0]
            for plan, place, best, step in blocks:
                row = place[terms]
                for at in range(0, len(n), step):
                    some = slice(ends[at], ends[min(at + step, len(n))])
                    inside = row[some] >= 0
                    parts = np.zeros((len(plan.terms), min(step, len(n) - at)), np.int64)
                    parts[row[some][inside], doc[some][inside] - at] = value[some][inside]
                    best.add(plan.scores(parts), known[at:at + step], ids[at:at + step])
        for plan, _, best, _ in blocks:
            item, score, known, ids = best.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(plan.ids, np.int64)[item], pa.int64()), pa.array(-score, pa.int64()),
                 pa.array(ids, pa.int64(), mask=known == 0)], ["item", "down", "doc_id"])
        del blocks
        release_memory()

    return run


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 50, doc_id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS,
                   plan_bytes: int = PLAN_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above
    0, highest first, equal scores by ascending doc_id.

    A document's score is the sum over the item's terms, once each, of w * ((1000000000 *
    tf) div (1000 * tf + 20 * m)) with w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and
    m = 50 + (50 * n * N) div L; all counts are over all documents.

    Rows of one item_id (also NULL) are one item with the terms of all their texts. Repeated
    documents are ranked each; a NULL doc_id comes before others of its score. NULL and empty
    texts have no terms; an item without terms or hits and an empty table give no rows.

    Documents are read once for each group of items whose plans fit ``plan_bytes``
    (once for a few thousand items): the number of each item term goes to a table, from
    which counts and then scores are made. A task sends at most ``top`` rows an item.
    """
    spark = docs.sparkSession
    asked = rows_of(items, item_id=item_id_col, text=item_text_col).select("item_id", F.col("text").cast("binary").alias("text"))
    docs = rows_of(docs, doc_id=doc_id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def split(batches):
        for batch in batches:
            terms = [sorted(set(terms_of(t.as_py()))) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    id_type = asked.schema["item_id"].dataType.simpleString()
    pairs = materialize(asked.mapInArrow(split, f"item_id {id_type}, terms array<binary>").select(
        "item_id", F.explode("terms").alias("term")).distinct())
    sizes = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_terms"))
    upto = materialize(running_totals(materialize(sizes.withColumn("one", F.lit(1))), "item_id", {"upto": "n_terms", "item": "one"}))
    numbered = upto.select("item_id", F.col("item").cast("bigint").alias("item"),
                           F.expr(f"CAST((upto - n_terms) DIV {block_terms} AS BIGINT)").alias("block"))
    same = pairs["item_id"].eqNullSafe(numbered["item_id"])
    plans = materialize(pairs.join(numbered, same).select("block", "item", "term").groupBy("block").applyInPandas(
        _plan, "block bigint, plan binary"))
    passes, room = [], 0
    for row in plans.select("block", F.octet_length("plan").alias("size")).orderBy("block").collect():
        if not passes or room < row["size"]:
            passes.append([])
            room = plan_bytes
        passes[-1].append(row["block"])
        room -= row["size"]
    found = []
    for blocks in passes:
        some = [bytes(r["plan"]) for r in plans.where(F.col("block").isin(blocks)).select("plan").collect()]
        vocabulary = sorted({t for p in some for t in Plan.load(p).terms})
        postings = materialize(docs.mapInArrow(
            _postings(spark.sparkContext.broadcast(vocabulary)), "doc_id bigint, n bigint, terms array<int>, times array<int>"))
        total = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weight = F.expr(f"CAST(floor(1000 * ln(CAST(2 * {total['docs']}L + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)")
        # One number a term of the items of this pass.
        weights, found_terms = np.zeros(len(vocabulary), np.int64), held.select("term", weight.alias("w")).toArrow()
        weights[found_terms["term"].to_numpy()] = found_terms["w"].to_numpy()
        shared = spark.sparkContext.broadcast((some, vocabulary, weights))
        found.append(postings.where("size(terms) > 0").mapInArrow(
            _rank(shared, total["docs"], total["terms"], top), "item bigint, down bigint, doc_id bigint"))
    if not found:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    best = _smallest(best, ["item"], top)
    rank = F.row_number().over(Window.partitionBy("item").orderBy("down", "doc_id"))
    return best.withColumn("rank", rank).join(F.broadcast(numbered) if len(passes) == 1 else numbered, "item").select(
        "item_id", "rank", "doc_id", (-F.col("down")).alias("score"))
