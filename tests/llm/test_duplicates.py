"""Exact and near duplicates and repeated strings, against brute force."""

import hashlib
import random
import string

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import functions as F

from cohortkit.llm import repeats
from cohortkit.llm.components import connected_components
from cohortkit.llm.digest_index import DigestIndex
from cohortkit.llm.repeats import order_by_prefix, prefix_classes, remove_repeats
from cohortkit.llm.simhash import Golay, bucket_forest, fingerprint, golay_keys, link_edges, near_duplicates, one_of_each_group

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_exact_dedup_rows(spark, docs_of, tmp_path):
    texts = ["A b", "a B", None, "", "É", "é", "x" * 200_000, "X" * 200_000, "a b"]
    docs = docs_of(texts)
    index = DigestIndex(spark, str(tmp_path / "index"), 4)
    got = {r["doc_id"]: r for r in index.add(docs).collect()}
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    for text, ids in groups.items():
        for i in ids:
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(ids), len(ids), i == max(ids))
            assert got[i]["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_exact_dedup_persists(spark, docs_of, tmp_path):
    path = str(tmp_path / "index")
    DigestIndex(spark, path, 4).add(docs_of(["a", "b"], ids=[5, 6])).collect()
    index = DigestIndex(spark, path, 4)
    again = docs_of(["b", "c", "B"], ids=[9, 10, 11])
    for _ in range(2):  # running a batch again changes nothing
        got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(again).collect()}
        assert got == {9: (6, False), 10: (10, True), 11: (6, False)}
    assert index.table().count() == 3
    assert sorted(r["doc_id"] for r in index.deduplicate(docs_of(["c", "d"], ids=[10, 12])).collect()) == [10, 12]
    plan = index.add(again).sparkSession.table(index.name)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "bucket" in plan.lower()


def test_exact_dedup_edges(spark, docs_of, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "index"), 2)
    assert index.add(docs_of([])).count() == 0
    docs = docs_of(["a", "a", "b", "a"], ids=[None, 3, None, 3])
    got = sorted(tuple(r) for r in index.add(docs).select("group_size", "kept").collect())
    assert got == [(1, True), (3, False), (3, True), (3, True)]
    assert sorted(index.add(docs).columns) == ["doc_id", "group_size", "keep_id", "kept", "text_sha256"]


def plain_fingerprint(text, words=3):
    tokens = "".join((text or "")).translate(LOWER).encode().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_plain_one(spark, docs_of):
    r = random.Random(1)
    texts = [None, "", " \t\n", "one", "One two", "a b c", "É\x0bx\x1cy z", "a b c d"] + [
        " ".join(r.choice(["Ab", "c", "ñd", "EFG"]) for _ in range(r.randint(1, 60))) for _ in range(60)]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    # Spark's own hash of a shingle is the same function.
    one = spark.sql("SELECT hex(xxhash64('one two three')) AS h").first()["h"]
    assert int(one, 16) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_golay_is_perfect():
    golay, words = Golay(), np.arange(1 << 23, dtype=np.uint32)
    counts = np.bincount(golay.decode(words), minlength=1 << 12)
    assert (counts == 1 << 11).all()


def test_keys_find_every_link_of_three_bits():
    golay, rng = Golay(), np.random.default_rng(2)
    for _ in range(300):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            y ^= 1 << int(b)
        (ka, _, pa), (kb, _, pb) = (golay_keys(np.array([v], np.uint64).view(np.int64), golay) for v in (x, y))
        assert set(ka[~pa]) & set(kb[pb]) and set(kb[~pb]) & set(ka[pa])


def components(ids, fps, bits=3):
    found = {}
    for i in range(len(fps)):
        found[i] = i
    def root(i):
        while found[i] != i:
            i = found[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                found[root(i)] = root(j)
    least = {}
    for i in range(len(fps)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least[root(i)] for i in range(len(fps))]


def near_fingerprints(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    out = []
    for _ in range(n):
        v = int(base[rng.integers(0, 6)])
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            v ^= 1 << int(b)
        out.append(v)
    return out


def test_links_give_the_components(spark):
    for n, block in ((400, 2048), (400, 8)):  # small buckets, and hot keys dealt to blocks
        fps = sorted(set(near_fingerprints(n, n + block)))
        signed = [int(v) for v in np.array(fps, np.uint64).view(np.int64)]
        df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
        roots = {r["node"]: r["root"] for r in connected_components(link_edges(df, 3, block)).collect()}
        assert [roots.get(v, v) for v in signed] == components(signed, fps)


def test_forest_connects_large_buckets():
    fps = np.array(sorted(set(near_fingerprints(700, 5))), np.uint64).view(np.int64)
    a, b = bucket_forest(fps, fps, 3)
    far = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))
    ids = list(range(len(fps)))
    want = components(ids, [int(v) for v in fps.view(np.uint64)])
    place = {int(v): i for i, v in enumerate(fps)}
    joined = {i: i for i in ids}
    def root(i):
        while joined[i] != i:
            i = joined[i]
        return i
    for x, y in zip(a.tolist(), b.tolist()):
        joined[root(place[x])] = root(place[y])
    groups, wanted = {}, {}
    for i in ids:
        groups.setdefault(root(i), set()).add(i)
        wanted.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    assert len(a) < len(fps) * 3 and far.max() <= 64


def test_components_of_a_chain_and_an_empty_table(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(edges.where("a < 0")).count() == 0


def test_near_duplicates(spark, docs_of):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    base = [" ".join(r.choice(words) for _ in range(400)) for _ in range(5)]
    texts = [None, "", "  "] + base + [b.upper() for b in base] + [b + " end" for b in base] + ["solo word here now"]
    ids = [i * 3 for i in range(len(texts))]
    docs = docs_of(texts, ids=ids)
    got = {x["doc_id"]: x for x in near_duplicates(docs).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    want = components(ids, fps)
    for i, fp, c in zip(ids, fps, want):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{fp:016x}", c)
    assert sorted(x["doc_id"] for x in one_of_each_group(docs).collect()) == sorted(set(want))
    assert near_duplicates(docs_of([])).count() == 0
    assert one_of_each_group(docs).columns == docs.columns


def test_copies_that_share_an_id_go(spark, docs_of, tmp_path):
    """One row of each text (component) stays, also of repeated rows and of rows without an id."""
    one, two, three = ("alpha beta gamma delta", "some other words that stand here", "nothing like the rest of them at all")
    texts = [one, one, one.upper(), two, two, three, three, one, three]
    docs = docs_of(texts, ids=[5, 5, 5, None, None, 8, 8, 2, None], sources=list("abcdefghi"))
    index = DigestIndex(spark, str(tmp_path / "index"), 2)
    for _ in range(2):
        got = index.deduplicate(docs)
        assert sorted((r["text"].lower(), r["doc_id"]) for r in got.collect()) == sorted([(one, 5), (two, None), (three, 8)])
        assert got.columns == docs.columns
    got = one_of_each_group(docs)
    assert sorted((r["text"].lower(), r["doc_id"]) for r in got.collect()) == sorted([(one, 2), (two, None), (three, 8)])
    assert got.columns == docs.columns
    # Ids that stand in two components, and two components without any id.
    docs = docs_of([one, one, two, two, three, three], ids=[5, 5, 5, 7, None, None])
    got = one_of_each_group(docs).unionByName(one_of_each_group(docs_of([one, one, two], ids=[None, None, None])))
    assert sorted(((r["text"], r["doc_id"]) for r in got.collect()), key=str) == sorted(
        [(one, 5), (two, 5), (three, None), (one, None), (two, None)], key=str)


def cut(docs):
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            k = b[s:s + 50]
            if i is not None and (k not in first or i < first[k]):
                first[k] = i
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 49):
            if i is not None and first[b[s:s + 50]] < i:
                gone[s:s + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark, docs_of):
    r = random.Random(11)
    base = ["".join(r.choice("abé \x00") for _ in range(300)) for _ in range(5)] + ["a" * 400, "ab" * 150]
    texts, ids = [None, "", "x" * 49, "x" * 50, "x" * 50, "é" * 24 + "ab", base[0], base[0]], [9, 8, 7, 6, 5, 4, None, None]
    for i in range(40):
        t = ""
        for _ in range(r.randint(0, 4)):
            b = r.choice(base)
            s = r.randrange(len(b))
            t += b[s:s + r.randint(0, 160)] + r.choice(["", "|", "ñ"])
        texts.append(t)
        ids.append(20 + i if r.random() < 0.9 else 20)
    for group_bytes in (8_000_000, 1500):
        got = remove_repeats(docs_of(texts, ids=ids), group_bytes)
        assert sorted((tuple(x) for x in got.collect()), key=str) == cut(list(zip(ids, texts)))
    assert remove_repeats(docs_of([])).count() == 0


def test_a_block_gets_each_piece_of_a_group_once():
    """Every byte of a ruler line is an occurrence of its own; the block's table does not grow with them."""
    group = pd.DataFrame({"g": 0, "doc_id": [1, 2, 3], "text": ["-" * 20_000, "ab" * 10_000, "-" * 30_000 + "ab" * 50], "copies": 1})
    shared = repeats._shared_anchors(repeats._anchor_blobs(1)(group))
    sent = repeats._pieces(1)(group, shared)
    unpack = zstandard.ZstdDecompressor().decompress
    raw = [unpack(x) if x[:4] == zstandard.FRAME_HEADER else x for c in sent for x in sent[c] if isinstance(x, bytes)]
    assert len(sent) == 1 and 0 < sum(map(len, raw)) < 5000


def test_pieces_that_meet_no_other_are_not_searched(monkeypatch):
    """A passage's pieces are the same in every document; only those at its ends meet different ones."""
    r = random.Random(14)
    text = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    passage = text(4000)
    texts = [text(200) + passage + text(200) for _ in range(4)]
    searched = []
    monkeypatch.setattr(repeats, "prefix_classes", lambda s, d: searched.append(len(s)) or prefix_classes(s, d))
    group = pd.DataFrame({"g": 0, "doc_id": range(4), "text": texts, "copies": 1})
    shared = repeats._shared_anchors(repeats._anchor_blobs(1)(group))
    sent = repeats._pieces(1)(group, shared)
    found = pd.concat([repeats._earlier_windows(sent, 1), shared.assign(block=repeats._ANCHORS)])
    n_bytes = sum(np.frombuffer(x, "<i2").sum() for x in sent["lengths"])
    assert 0 < sum(searched) < n_bytes / 8
    got = repeats._cut(group, found, 1)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(got[columns].itertuples(index=False, name=None), key=str) == cut(list(enumerate(texts)))


def test_large_ids_are_split(spark, docs_of):
    """Rows without an id, an id on a third of the rows and an equal row many times meet in no one group."""
    r = random.Random(5)
    base = "".join(r.choice("abcd ") for _ in range(4000))
    part = lambda: base[(s := r.randrange(3800)):s + 200]
    same = part()
    texts = [part() for _ in range(180)] + [same] * 40 + ["-" * 120, "-" * 90]
    ids = [(None, 7, i)[i % 3] for i in range(180)] + [7] * 40 + [6, 1000]
    docs = docs_of(texts, ids=ids)
    dealt, n_groups = repeats._dealt(docs.select("doc_id", "text"), 2000)
    sizes = dealt.groupBy("g").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert max(x["n"] for x in sizes) < 6000 and n_groups == -(-sum(len(t) for t, i in zip(texts, ids) if i is not None) // 2000)
    assert dealt.where("doc_id IS NULL").isEmpty() and dealt.where("doc_id = 7").agg(F.sum("copies")).first()[0] == 100
    got = remove_repeats(docs, 2000).collect()
    assert sorted((tuple(x) for x in got), key=str) == cut(list(zip(ids, texts)))


def test_repeats_returns_texts(spark, docs_of):
    shared = "The same passage of well over fifty bytes stands in two documents."
    got = {x["doc_id"]: bytes(x["kept_text"]) for x in remove_repeats(
        docs_of([shared + " one", "two " + shared]), with_text=True).collect()}
    assert got == {0: (shared + " one").encode(), 1: b"two "}


def test_interval_expansion_is_prefix_equality():
    rng = np.random.default_rng(4)
    for n, depth in ((1, 5), (40, 3), (500, 6), (3000, 50)):
        symbols = rng.integers(97, 99, n).astype(np.uint8)
        symbols[n // 2:] = symbols[: n - n // 2]
        order, classes = prefix_classes(symbols, depth)
        ring = bytes(np.resize(symbols, n + depth))
        words = [ring[i:i + depth] for i in order]
        assert words == sorted(words) and sorted(order) == list(range(n))
        assert [a == b for a, b in zip(classes[1:], classes)] == [a == b for a, b in zip(words[1:], words)]
        assert [ring[i:i + depth] for i in order_by_prefix(symbols, depth)] == words


def test_two_batches_are_one_table(spark, medium, tmp_path):
    """The index decides about the second batch at size; the rule is that of one batch."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    groups = {}
    for r in docs.collect():
        groups.setdefault(hashlib.sha256((r["text"] or "").translate(LOWER).encode()).hexdigest(), []).append(r["doc_id"])
    assert max(map(len, groups.values())) > 1
    for batches in (1, 2, 5):
        index = DigestIndex(spark, str(tmp_path / f"index{batches}"), 4)
        got = index.add_from_largest(docs, batches).collect()
        assert len(got) == docs.count() and index.table().count() == len(groups)
        for r in got:
            ids = groups[r["text_sha256"]]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(ids), len(ids), r["doc_id"] == max(ids))
    # Later ids second: what the first batch has stays, and only new texts are appended.
    index, half = DigestIndex(spark, str(tmp_path / "later"), 4), docs.agg(F.expr("median(doc_id)")).first()[0]
    first = {r["text_sha256"]: r["keep_id"] for r in index.add(docs.where(F.col("doc_id") < half)).collect()}
    for r in index.add(docs.where(F.col("doc_id") >= half)).collect():
        ids = [i for i in groups[r["text_sha256"]] if i >= half]
        assert r["keep_id"] == first.get(r["text_sha256"], max(ids)) and r["kept"] == (r["doc_id"] == r["keep_id"])
    assert index.table().count() == len(groups)
    index.drop()
    assert not (tmp_path / "later").exists() and not spark.catalog.tableExists(index.name)


def test_batches_of_odd_ids(spark, docs_of, tmp_path):
    texts, ids = ["a", "A", "b", None, "", "b", "c", "a"], [None, -5, None, 7, 2**40, None, 3, 3]
    got = DigestIndex(spark, str(tmp_path / "i"), 2).add_from_largest(docs_of(texts, ids=ids), 3).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in got) == sorted([
        ("None", "3", 3, False), ("-5", "3", 3, False), ("3", "3", 3, True), ("None", "None", 2, True), ("None", "None", 2, True),
        ("7", str(2**40), 2, False), (str(2**40), str(2**40), 2, True), ("3", "3", 1, True)])
    for empty in (docs_of([]), docs_of(["x"], ids=[None])):
        assert DigestIndex(spark, str(tmp_path / f"e{empty.count()}"), 2).add_from_largest(empty).count() == empty.count()


def test_windows_of_heavy_anchors(spark, docs_of):
    """Any anchor may count as heavy; what is removed stays the same."""
    r = random.Random(12)
    base = ["".join(r.choice("abé \x00") for _ in range(300)) for _ in range(4)] + ["a" * 200, "ab" * 90]
    phrase = "one phrase of more than fifty bytes stands in a third of all the documents"
    texts = [r.choice(["", phrase]) + (b := r.choice(base))[(s := r.randrange(len(b))):s + r.randint(0, 160)] + r.choice(["", phrase[:20], "ñ"])
             for _ in range(60)] + [None, ""]
    ids = [i if i % 7 else 3 for i in range(len(texts))]
    want = cut(list(zip(ids, texts)))
    for heavy_docs, group_bytes in ((1, 8_000_000), (1, 1500), (6, 1500)):
        got = remove_repeats(docs_of(texts, ids=ids), group_bytes, heavy_docs=heavy_docs).collect()
        assert sorted((tuple(x) for x in got), key=str) == want


def test_a_phrase_in_every_document_is_spread():
    """20 and 60 bytes that all documents share: no block gets more than a few times what others get."""
    r = random.Random(13)
    text = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(120))
    unpack = zstandard.ZstdDecompressor().decompress

    def block_bytes(phrase, heavy_docs):
        group = pd.DataFrame({"g": 0, "doc_id": range(1500), "text": [text() + phrase + text() for _ in range(1500)], "copies": 1})
        shared = repeats._shared_anchors(repeats._anchor_blobs(1)(group), heavy_docs)
        sent = repeats._pieces(32)(group, shared)
        spread = sent[sent["block"] >= 32] if (sent["block"] >= 32).any() else sent
        return sorted(len(unpack(x)) for x in spread["bytes"])

    for phrase in ("one phrase of twenty", "sixty bytes of text that stand in every one of the documents"):
        light, heavy = block_bytes(phrase, 10**9), block_bytes(phrase, 500)
        assert light[-1] > 0.2 * sum(light) and len(heavy) == 32 and heavy[-1] < 2 * heavy[16]


def test_a_job_takes_its_index_along(spark, small):
    import os

    from cohortkit.llm.queries import QUERIES
    from cohortkit.session import scratch, shared_folder

    before = set(os.listdir(shared_folder(spark))), {t.name for t in spark.catalog.listTables()}
    with scratch(spark):
        assert QUERIES["op8_exact_dedup"](spark, small).count() > 0
    assert (set(os.listdir(shared_folder(spark))), {t.name for t in spark.catalog.listTables()}) == before
