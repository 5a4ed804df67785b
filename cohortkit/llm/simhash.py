"""Near-duplicates by 64-bit fingerprints, found through Golay-code keys.

A fingerprint is cut into three segments of 22, 21 and 21 bits, each a (shortened) word
of the perfect (23, 12) Golay code: every word decodes to the one codeword within three
bits. Words at most one bit apart share a key when one side gives its own decoding and
the other the decodings of all words one flip away (about six different ones). With at
most three differing bits, two segments always differ by one bit or less, so keys over
pairs of segments find every link: three index keys and about 58 probe keys each.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortkit.llm.common import first_row, release_memory, rows_of
from cohortkit.llm.components import connected_components
from cohortkit.operators.sizing import small_side
from cohortkit.session import materialize

SEED = 42
MAX_BITS = 3
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits)
# Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
# A key with more index rows than this is dealt out in blocks of about this size.
BLOCK = 2048
# Buckets up to this many comparisons give their links; larger ones give a spanning forest.
SMALL_BUCKET = 1024
_SHINGLES_AT_ONCE = 200_000


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash over shingles of ``words`` words, A-Z lower-cased; no words: 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    digest, width = xxhash.xxh64_intdigest, min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(tokens) - width + 1].tolist(), ends[width - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        span = zip(starts[at:at + _SHINGLES_AT_ONCE], ends[at:at + _SHINGLES_AT_ONCE])
        hashes = np.array([digest(joined[s:e], SEED) for s, e in span], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as a signed BIGINT."""

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], ["doc_id", "fp"])
        release_memory()

    rows = rows_of(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


class Golay:
    """Decoding of the (23, 12) Golay code by syndrome."""

    def __init__(self):
        def remainder(word: int) -> int:
            for bit in range(22, 10, -1):
                if word >> bit & 1:
                    word ^= GENERATOR << bit - 11
            return word

        self.high = np.array([remainder(h << 11) for h in range(1 << 12)], np.uint32)
        self.error = np.zeros(1 << 11, np.uint32)
        for weight in (1, 2, 3):
            for bits in itertools.combinations(range(23), weight):
                word = sum(1 << b for b in bits)
                self.error[remainder(word)] = word

    def decode(self, words: np.ndarray) -> np.ndarray:
        """The 12-bit index of the codeword nearest to each 23-bit word."""
        return (words ^ self.error[self.high[words >> 11] ^ (words & 0x7FF)]) >> 11

    def nearby(self, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, index) of the different codewords of each word and its one-bit neighbours."""
        flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
        found = np.sort(self.decode(words[:, None] ^ flips), axis=1)
        first = np.ones(found.shape, bool)
        first[:, 1:] = found[:, 1:] != found[:, :-1]
        rows, columns = np.nonzero(first)
        return rows, found[rows, columns]


def golay_keys(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fp, probe) rows such that any two fingerprints at most three bits apart share
    a key, one as an index row and the other as a probe row."""
    words = fps.view(np.uint64)
    parts = [((words >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.uint32) for s, b in SEGMENTS]
    own = [golay.decode(p).astype(np.int64) for p in parts]
    near = [golay.nearby(p, b) for p, (_, b) in zip(parts, SEGMENTS)]
    everyone = np.arange(len(fps))
    keys, who, probes = [], [], []

    def add(pair, rows, a, b, probe):
        keys.append((pair << 24 | a << 12 | b).astype(np.int64))
        who.append(rows)
        probes.append(np.full(len(rows), probe))

    for pair, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
        add(pair, everyone, own[x], own[y], False)
        (rows_x, near_x), (rows_y, near_y) = near[x], near[y]
        if pair == 0:  # up to one bit in both
            per_row = np.bincount(rows_y, minlength=len(fps))
            first_y = np.cumsum(per_row) - per_row
            times = per_row[rows_x]
            offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            add(pair, np.repeat(rows_x, times), np.repeat(near_x, times),
                near_y[np.repeat(first_y[rows_x], times) + offset], True)
        else:  # up to one bit in one of them
            add(pair, rows_x, near_x, own[y][rows_x], True)
            other = near_y != own[y][rows_y]
            add(pair, rows_y[other], own[x][rows_y[other]], near_y[other], True)
    who = np.concatenate(who)
    return np.concatenate(keys), fps[who], np.concatenate(probes)


def _key_rows(batches):
    golay = Golay()
    for batch in batches:
        fps = batch["fp"].to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            keys, fp, probe = golay_keys(fps[at:at + 4096], golay)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp), pa.array(probe)], ["key", "fp", "probe"])
    del golay
    release_memory()


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def bucket_forest(index: np.ndarray, probes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same fingerprints as all links between index and probes do."""
    labels, a, b = np.arange(len(index)), [], []
    for at in range(0, len(probes), 1024):
        some = probes[at:at + 1024]
        far = _far(some[:, None], index[None, :])
        hit = (far <= max_bits) & (far > 0)
        some, hit = some[hit.any(1)], hit[hit.any(1)]
        if not len(some):
            continue
        a.append(some)
        b.append(index[hit.argmax(1)])
        while True:  # join the index classes that one probe touches
            low = np.where(hit, labels, len(index)).min(1)
            high = np.where(hit, labels, -1).max(1)
            apart = low != high
            if not apart.any():
                break
            pairs = np.unique(np.stack((high[apart], low[apart]), 1), axis=0)
            pairs = pairs[np.unique(pairs[:, 0], return_index=True)[1]]  # one new class for each
            a.append(index[pairs[:, 0]])
            b.append(index[pairs[:, 1]])
            to = np.arange(len(index))
            to[pairs[:, 0]] = pairs[:, 1]
            while (to[to] != to).any():
                to = to[to]
            labels = to[labels]
    if not a:
        return index[:0], index[:0]
    return np.concatenate(a), np.concatenate(b)


def bucket_links(keys: np.ndarray, fps: np.ndarray, probes: np.ndarray, max_bits: int):
    """Edges from whole buckets: rows sorted by key, index rows first."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    asked = np.add.reduceat(probes.astype(np.int64), starts)
    held = sizes - asked
    work = held * asked
    out_a, out_b = [], []
    small = np.flatnonzero((work > 1) & (work <= SMALL_BUCKET))
    for at in range(0, len(small), 2000):
        part = small[at:at + 2000]
        n = work[part]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first, wide = np.repeat(starts[part], n), np.repeat(asked[part], n)
        x = fps[first + offset // wide]
        y = fps[first + np.repeat(held[part], n) + offset % wide]
        near = _far(x, y)
        near = (near <= max_bits) & (near > 0)
        out_a.append(x[near])
        out_b.append(y[near])
    for k in np.flatnonzero(work > SMALL_BUCKET):
        s = starts[k]
        a, b = bucket_forest(fps[s:s + held[k]], fps[s + held[k]:s + sizes[k]], max_bits)
        out_a.append(a)
        out_b.append(b)
    a = np.concatenate(out_a) if out_a else fps[:0]
    b = np.concatenate(out_b) if out_b else fps[:0]
    return np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), 1), axis=0)


def _links(max_bits: int, at_once: int = 400_000):
    """Rows sorted by (bucket, probe) to edges; holds one run of buckets at a time, and of
    a bucket that is larger than that only its index rows (bounded by BLOCK)."""

    def edges(rows):
        found = bucket_links(*rows, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            new = [batch[c].to_numpy(zero_copy_only=False) for c in ("bucket", "fp", "probe")]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) < at_once:
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield edges([x[:cut] for x in held])
                held = [x[cut:] for x in held]
            elif held[2][-1]:
                yield edges(held)
                held = [x[~held[2]] for x in held]
        if held is not None and len(held[0]):
            yield edges(held)
        del held
        release_memory()

    return run


def link_edges(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` just as all links do.

    A key that many index rows share (a large group of near copies) is dealt out: its
    index rows to blocks of bounded size, its probe rows to each block.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find up to {MAX_BITS} differing bits")
    rows = fps.select("fp").mapInArrow(_key_rows, "key bigint, fp bigint, probe boolean")
    hot = materialize(
        rows.where(~F.col("probe")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
        .select("key", F.ceil(F.col("n") / block).cast("bigint").alias("blocks")))
    bucket = F.col("key")
    if not hot.isEmpty():
        blocks = F.coalesce("blocks", F.lit(1).cast("bigint"))
        rows = rows.join(hot, "key", "left").select(
            "key", "fp", "probe",
            F.explode(F.when(F.col("probe"), F.sequence(F.lit(0).cast("bigint"), blocks - 1))
                      .otherwise(F.array(F.pmod(F.xxhash64("fp"), blocks)))).alias("part"))
        bucket = F.col("key") + (F.col("part") * F.lit(1 << 26))
    rows = rows.select(bucket.alias("bucket"), "fp", "probe")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "probe")
    return rows.mapInArrow(_links(max_bits), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked;
    component_id is the smallest doc_id that links reach. Texts without words (NULL and
    empty ones too) have fingerprint zero and are linked like any other; fewer words than
    a shingle has are one shingle. Repeated rows come back repeated; a NULL id is never
    the smallest unless its component has no other. An empty table gives no rows.

    Equal fingerprints are merged before any key is made, so exact copies cost one row.
    """
    prints, decided = _components(docs, words, max_bits, id_col, text_col)
    return prints.join(decided, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _components(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of all rows, and (fp, root, component_id) of all fingerprints."""
    prints = materialize(fingerprints(docs, words, id_col, text_col))
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(link_edges(nodes, max_bits))
    labelled = materialize(
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints, materialize(labelled.join(smallest, "root").select("fp", "root", "component_id"))


def one_of_each_group(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component one row, with all its columns, whose id is the smallest; of
    several rows with that id (or of rows without one) the first by its JSON form.

    Ids that go are broadcast if they were counted to be few, else joined. Only where an
    id that stays is on several rows are their texts fingerprinted once more, to tell which
    of them stand in its component; they are reduced to one in each task before they move.
    """
    prints, decided = _components(docs, words, max_bits, id_col, text_col)
    own = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = prints.join(decided, "fp").groupBy("doc_id").agg(own.alias("kept"), F.count(F.lit(1)).alias("n"))
    ids = materialize(ids.where("NOT kept OR n > 1").withColumnRenamed("doc_id", "found_id"))
    text = F.col(f"`{text_col}`")
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("own_id"), text.alias("own_text"))
    same = F.col("own_id").eqNullSafe(F.col("found_id"))
    stay = held.join(small_side(ids.where("NOT kept").select("found_id")), same, "left_anti")
    again = ids.where("kept").select("found_id")
    if again.isEmpty():
        return stay.select("row.*")
    again = small_side(again)
    several = stay.join(again, same, "left_semi").withColumn(
        "own_digest", F.sha2(F.coalesce("own_text", F.lit("")).cast("binary"), 256))
    texts = several.groupBy("own_digest").agg(F.min("own_text").alias("own_text"))
    roots = fingerprints(texts, words, "own_digest", "own_text").join(decided, "fp").select(
        F.col("doc_id").alias("own_digest"), "root", "component_id")
    one = several.join(roots, "own_digest").where(F.col("own_id").eqNullSafe(F.col("component_id")))
    one = one.groupBy("root").agg(first_row("row").alias("row"))
    return stay.join(again, same, "left_anti").select("row.*").unionByName(one.select("row.*"))
