"""Hard negatives and ranked search against plain versions, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import hard_negatives as hn
from cohortkit.llm import lexical

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain_negatives(table, every=10):
    """``table``: (id, label, vec) rows, vec of whole numbers."""
    rows = list({(i, label, tuple(v)) for i, label, v in table})
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for a in rows:
        if a[0] % every:
            continue
        ranked = sorted((r for r in rows if r is not a), key=lambda r: (-score(a, r), r[0]))
        for p in [r for r in ranked if r[1] == a[1]][:5]:
            s = score(a, p)
            fit = [r for r in ranked if r[1] != a[1] and 30 * s <= 100 * score(a, r) <= 90 * s][:10]
            out += [(a[0], p[0], n, r[0], s, score(a, r)) for n, r in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, table, **more):
    rows = spark.createDataFrame(table, "id bigint, label bigint, vec array<bigint>")
    return sorted(tuple(r[c] for c in COLUMNS) for r in hn.hard_negatives(rows, F.col("id") % 10 == 0, **more).collect())


@pytest.mark.parametrize("seed, width, spread, block", [(1, 6, 9, 8192), (2, 3, 2, 40), (3, 2, 1, 7), (4, 40, 100, 60)])
def test_negatives(spark, monkeypatch, seed, width, spread, block):
    monkeypatch.setattr(hn, "LEAF_ROWS", min(block, 64))
    monkeypatch.setattr(hn, "BLOCK_CELLS", 1 << 20 if block > 50 else 100)
    rng = random.Random(seed)
    table = [(i, rng.randrange(3), [rng.randint(-spread, 2 * spread) for _ in range(width)]) for i in range(300)]
    table += [(i + 300, 1, table[0][2]) for i in range(90)]  # one vector that is very common
    got = mined(spark, table, block_rows=block, block_queries=16)
    assert got == plain_negatives(table) and got


def test_negatives_odd_rows(spark):
    long, short = [5] * 70, [3]
    table = [(0, 0, long), (10, 0, short), (20, 1, []), (1, 0, [4, 4]), (2, 1, [4]), (3, 1, [2, 1]), (3, 1, [2, 1]), (3, 1, [3]), (4, 2, [1] * 80)]
    assert mined(spark, table) == plain_negatives(table)
    assert mined(spark, table[:1]) == [] and mined(spark, []) == []


def test_negatives_beyond_doubles(spark):
    big = 3 * 10 ** 8 + 1
    table = [(0, 0, [big, 7]), (1, 0, [big, 1]), (2, 1, [big // 2, 3]), (3, 1, [big // 2, 2]), (4, 1, [big - 1, 0]), (5, 0, [big // 3, 1])]
    assert mined(spark, table) == plain_negatives(table)


def test_quantised(spark):
    nan = float("nan")
    rows = [(1, 3, [0.5, -0.001]), (2, None, [1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [nan]), (6, 1, [math.inf]), (7, 9, []), (None, 1, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumns({"id": F.lit("x"), "vec": F.lit(1)})
    label = F.expr("CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    assert sorted(map(tuple, hn.quantised(df, label=label).collect())) == [(1, 3, [128, -1]), (7, 0, [])]


def test_tree_boxes_hold_their_rows():
    rng = np.random.default_rng(5)
    vectors, labels = rng.integers(-20, 20, (2000, 5)).astype(float), rng.integers(0, 4, 2000)
    tree = hn.RTree(labels, vectors)
    assert sorted(tree.order) == list(range(2000)) and tree.leaves >= 2000 // hn.LEAF_ROWS
    query = rng.integers(-20, 20, (1, 5)).astype(float)
    top = np.maximum(query, 0) @ tree.high.T + np.minimum(query, 0) @ tree.low.T
    for leaf in range(tree.leaves):
        rows = tree.vectors[leaf * hn.LEAF_ROWS:(leaf + 1) * hn.LEAF_ROWS]
        node = leaf
        while node >= 0:
            assert (rows >= tree.low[node]).all() and (rows <= tree.high[node]).all() and (rows @ query[0] <= top[0, node]).all()
            node = tree.parent[node]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranking(docs, items, top=50):
    """``docs``: (id, text); ``items``: (id, text)."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in held:
            m = 50 + (50 * sum(c.values()) * n_docs) // length if length else 0
            score = sum(math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        found.sort(key=lambda x: x[:3])
        out += [(item, n, x[3], -x[0]) for n, x in enumerate(found[:top], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"n": F.lit(1), "terms": F.lit("x"), "item": F.lit(2)})
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("block", F.lit(9))
    got = lexical.rank_documents(d, i, **more).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("block_terms, plan_bytes", [(16_384, 1 << 25), (40, 1), (40, 4000)])
def test_ranking(spark, block_terms, plan_bytes):
    rng = random.Random(7)
    words = [w + x for w in ("ab", "Ünd", "c3", "d", "ö") for x in ("", "1", "e", "ß", "Z")]
    text = lambda n: " ".join(rng.choices(words, range(1, 26), k=n)) + rng.choice(["", ".", "-x_y"])
    docs = [(i, text(rng.randrange(0, 40))) for i in range(150)] + [(3, "d d d1"), (3, "d d d1"), (None, "d d d1"), (900, None), (901, ""), (902, "?!")]
    docs += [(1000 + i, "d dZ de") for i in range(70)]  # ties
    items = [(i, text(12)) for i in range(25)] + [(30, "d"), (31, None), (32, "nowhere"), (4, "d1 d1 dß"), (None, "ab c3")]
    got = ranked(spark, docs, items, block_terms=block_terms, plan_bytes=plan_bytes)
    assert got == plain_ranking(docs, items) and len(got) > 500


def test_ranking_odd_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == [] and ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, None), (2, " . ")], [(1, "a")]) == []
    docs, items = [(1, "x " * 300_000 + "y"), (2, "y")], [(1, "y x"), (1, "y x")]
    assert ranked(spark, docs, items) == plain_ranking(docs, items)


def test_plan_shares_and_adds_up():
    rng = random.Random(3)
    words = [b"w%d" % i for i in range(60)]
    common = [rng.sample(words, 6) for _ in range(5)]
    items = {i: set(sum(rng.sample(common, 2), [])) | set(rng.sample(words, 4)) for i in range(80)}
    plan = lexical.Plan.load(lexical.Plan(items).dump())
    values = np.array([[rng.randrange(1000) for _ in range(3)] for _ in plan.terms], np.int64)
    got, place = plan.scores(values), {t: i for i, t in enumerate(plan.terms)}
    for row, terms in zip(got, items.values()):
        assert (row == values[[place[t] for t in terms]].sum(0)).all()
    # Adding up takes less than each item for itself.
    assert len(plan.terms) + plan.n_nodes - plan.n_sets + len(plan.nodes) < sum(map(len, items.values())) // 2
