"""Toxicity: a linear classifier over character n-grams scaled by log-count ratios.

The features are which n-grams of 3 to 5 characters a text holds, hashed to 2^FEATURE_BITS
numbers. Each is scaled by its naive Bayes log-count ratio between toxic and other texts; a
logistic regression on the scaled features gives the score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.llm.common import release_memory, rows_of
from cohortkit.session import materialize

ORDERS = (3, 4, 5)
FEATURE_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)
# Bound of the training sample: rows of each class.
ROWS_PER_CLASS = 1500
# An n-gram of fewer training texts tells nothing that can be trusted.
LEAST_TEXTS = 3
_CHUNK = 1 << 20


@dataclass
class Weights:
    features: np.ndarray  # ids of the kept n-grams, ascending
    values: np.ndarray
    bias: float


def ngram_ids(points: np.ndarray):
    """Ids of all n-grams of characters, an array per order and stretch of the text."""
    for at in range(0, max(1, len(points)), _CHUNK):
        part = points[at:at + _CHUNK + max(ORDERS) - 1].astype(np.uint64)
        gram = part
        for order in range(2, max(ORDERS) + 1):
            if len(gram) < 2:
                break
            gram = gram[:-1] * _STEP + part[order - 1:]
            if order in ORDERS:
                yield ((gram + np.uint64(order << 56)) * _MIX) >> np.uint64(64 - FEATURE_BITS)


def characters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text between two spaces."""
    return np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def features(text: str | None) -> np.ndarray:
    """The different feature ids of a whole text."""
    held = np.zeros(1 << FEATURE_BITS, bool)
    for ids in ngram_ids(characters(text)):
        held[ids] = True
    return np.flatnonzero(held).astype(np.int32)


def _constant(labels: np.ndarray) -> Weights:
    """Every text scores the share of toxic rows."""
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    return Weights(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))


def _kept_ratios(toxic: np.ndarray, other: np.ndarray, labels: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(kept feature ids, their log-count ratios) from the texts of each class that hold a feature."""
    toxic, other = alpha + toxic, alpha + other
    ratio = np.log((toxic / toxic.sum()) / (other / other.sum()))
    ratio -= np.log(((labels.sum() + alpha) / toxic.sum()) / (((1 - labels).sum() + alpha) / other.sum()))
    keep = np.flatnonzero((toxic + other >= LEAST_TEXTS + 2 * alpha))
    return keep, ratio[keep]


def _regress(keep: np.ndarray, scale: np.ndarray, column: np.ndarray, ends: np.ndarray, labels: np.ndarray, rounds: int, l2: float) -> Weights:
    """Logistic regression by full-batch Adam; text i holds the features ``keep[column[ends[i]:ends[i + 1]]]``.

    Texts are gone through in stretches, so that little more than ``column`` is held.
    """
    w, bias = np.ones(len(keep)) * 0.1, 0.0
    m, v = np.zeros(len(keep) + 1), np.zeros(len(keep) + 1)
    balance = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    cuts = [0]
    while cuts[-1] < len(labels):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] + _CHUNK, side="right")) - 1))
    for step in range(1, rounds + 1):
        each, gradient = scale * w, np.zeros(len(keep) + 1)
        for s, e in zip(cuts[:-1], cuts[1:]):
            held = column[ends[s]:ends[e]]
            text = np.repeat(np.arange(e - s), np.diff(ends[s:e + 1]))
            score = bias + np.bincount(text, each[held], e - s)
            error = balance[s:e] * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[s:e]) / len(labels)
            gradient[:-1] += np.bincount(held, error[text], len(keep))
            gradient[-1] += error.sum()
        gradient[:-1] = scale * gradient[:-1] + l2 * w / len(keep)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Weights(keep.astype(np.int64), w * scale, float(bias))


def fit(texts: list[str], labels: np.ndarray, rounds: int = 60, l2: float = 1e-2, alpha: float = 1.0) -> Weights:
    """Log-count ratios, then logistic regression, in numpy."""
    labels = np.asarray(labels, np.float64)
    if not len(texts) or labels.min() == labels.max():
        return _constant(labels)
    held = [features(t) for t in texts]
    ids = np.concatenate(held)
    document = np.repeat(np.arange(len(texts)), [len(h) for h in held])
    size = 1 << FEATURE_BITS
    keep, scale = _kept_ratios(
        np.bincount(ids, labels[document], size), np.bincount(ids, 1 - labels[document], size), labels, alpha)
    place = np.full(size, -1, np.int32)
    place[keep] = np.arange(len(keep))
    used = place[ids] >= 0
    ends = np.concatenate(([0], np.cumsum(np.bincount(document[used], minlength=len(texts)))))
    return _regress(keep, scale, place[ids[used]], ends, labels, rounds, l2)


def _feature_arrays(batches):
    for batch in batches:
        for i in range(len(batch)):
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(i, 1), batch["toxic"].slice(i, 1),
                 pa.array([features(batch["text"][i].as_py())], pa.list_(pa.int32()))], ["doc_id", "toxic", "ids"])


def learn(
    docs: DataFrame, labels: DataFrame, train: Column | None = None, rows_per_class: int = ROWS_PER_CLASS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rounds: int = 60, l2: float = 1e-2,
    alpha: float = 1.0,
) -> Weights:
    """Fits, as ``fit`` does, on a bounded number of whole texts: of each class the
    ``rows_per_class`` labelled rows (ids in ``labels``, those that ``train`` allows) with
    the smallest id hashes. NULL ids, labels and texts teach nothing; of rows with one id
    the greatest text teaches; without both classes every text scores the share of the one
    there is.

    Tasks find the features of the texts and count them by class; the driver gets the
    counts (FEATURE_BITS bounds them) and of each text which of the features that
    LEAST_TEXTS texts have it holds, so that no text reaches it, however long.
    """
    marks = rows_of(labels, doc_id=id_col, toxic=label_col).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    if train is not None:
        marks = marks.where(train)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.withColumn("draw", F.xxhash64(F.lit("toxicity"), F.col("doc_id").cast("string")))
    chosen = None
    for value in (0, 1):
        some = marks.where(F.col("toxic") == value).orderBy("draw", "doc_id").limit(rows_per_class)
        chosen = some if chosen is None else chosen.union(some)
    marked = [(r["doc_id"], r["toxic"]) for r in chosen.select("doc_id", "toxic").collect()]
    if not marked:
        return _constant(np.zeros(0))
    id_type = marks.schema["doc_id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(marked, f"doc_id {id_type}, toxic int")
    rows = rows_of(docs, doc_id=id_col, text=text_col).where("text IS NOT NULL").join(F.broadcast(wanted), "doc_id")
    # An id may be repeated any number of times; one text of each teaches.
    rows = rows.select(F.col("doc_id").cast(id_type).alias("doc_id"), "toxic", "text")
    texts = rows.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    held = materialize(texts.mapInArrow(_feature_arrays, f"doc_id {id_type}, toxic int, ids array<int>"))
    of = {r["doc_id"]: r["toxic"] for r in held.select("doc_id", "toxic").collect()}
    order = sorted(of, key=lambda k: (zlib.crc32(str(k).encode()), str(k)))
    marks_of = np.array([of[k] for k in order], np.float64)
    if not order or marks_of.min() == marks_of.max():
        return _constant(marks_of)
    counts = held.select("toxic", F.explode("ids").alias("id")).groupBy("id").agg(
        F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).toArrow()
    ids, ones, n = (counts[c].to_numpy() for c in ("id", "toxic", "n"))
    toxic, other = np.zeros(1 << FEATURE_BITS), np.zeros(1 << FEATURE_BITS)
    toxic[ids], other[ids] = ones, n - ones
    keep, scale = _kept_ratios(toxic, other, marks_of, alpha)
    shared = docs.sparkSession.sparkContext.broadcast(keep.astype(np.int32))

    def columns(batches):
        place = np.full(1 << FEATURE_BITS, -1, np.int32)
        place[shared.value] = np.arange(len(shared.value), dtype=np.int32)
        for batch in batches:
            found = [(p := place[np.asarray(x.values)])[p >= 0] for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(pa.int32()))], ["doc_id", "places"])

    kept = held.select("doc_id", "ids").mapInArrow(columns, f"doc_id {id_type}, places array<int>").toArrow()
    at = {k: i for i, k in enumerate(kept["doc_id"].to_pylist())}
    places = kept["places"].combine_chunks().take(pa.array([at[k] for k in order], pa.int64()))
    del kept
    return _regress(keep, scale, places.values.to_numpy(), places.offsets.to_numpy().astype(np.int64), marks_of, rounds, l2)


class Scorer:
    def __init__(self, weights: Weights):
        self.table = np.zeros(1 << FEATURE_BITS, np.float64)
        self.table[weights.features] = weights.values
        self.used = np.zeros(1 << FEATURE_BITS, bool)
        self.used[weights.features] = True
        self.bias = weights.bias

    def score(self, text: str | None) -> float:
        found = [ids[self.used[ids]] for ids in ngram_ids(characters(text))]
        total = self.bias + (self.table[np.unique(np.concatenate(found))].sum() if found else 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def score_toxicity(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Whole texts are scored; NULL counts as empty, and an empty text gets the score of its
    few boundary n-grams. One pass without a shuffle; the broadcast model holds at most
    2^FEATURE_BITS numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rows = rows_of(docs, doc_id=id_col, text=text_col)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.score(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())],
                ["doc_id", "score", "predicted"])
        del scorer
        release_memory()

    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
