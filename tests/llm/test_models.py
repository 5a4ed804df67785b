"""Language, toxicity and personal data: held-out accuracy, brute force and edge rows."""

import random
import re
import zlib

import numpy as np

from cohortkit.llm import language, pii, toxicity
from cohortkit.llm.common import id_remainder
from cohortkit.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def test_language_on_held_out_rows(spark, medium):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    rows = QUERIES["op6_language"](spark, medium).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_language_edges(spark, docs_of):
    train = docs_of(["the cat and the dog ran off " * 5, "der hund und die katze liefen " * 5, None, "le chat"], langs=["en", "de", "en", None])
    known = language.learn_dictionaries(train)
    assert set(known) == {"en", "de"}
    texts = [None, "", "12 34 !?", "the dog and the cat", "die katze und der hund " * 20_000, "the dog and the cat"]
    got = language.identify_language(docs_of(texts), known).collect()
    assert [(r["lang_pred"], r["rejected"]) for r in got[:3]] == [("und", True)] * 3
    assert [r["lang_pred"] for r in got[3:]] == ["en", "de", "en"]
    assert [r["lang_pred"] for r in language.identify_language(docs_of(texts), {}).collect()] == ["und"] * 6
    assert language.identify_language(docs_of([]), known).count() == 0
    assert language.learn_dictionaries(docs_of([])) == {}
    kept = language.filter_language(docs_of(texts), known)
    assert [r["doc_id"] for r in kept.collect()] == [3, 4, 5] and kept.columns == docs_of(texts).columns
    # equal sizes: the first by name, rejected
    twins = language.identify_language(docs_of(["some words"]), {"b": known["en"], "a": known["en"]}).first()
    assert (twins["lang_pred"], twins["score"], twins["rejected"]) == ("a", 0.0, True)


def test_language_ignores_held_out_rows(spark, docs_of):
    texts = [f"word{i} " * 30 for i in range(40)]
    known = language.learn_dictionaries(docs_of(texts), id_remainder("doc_id", 4) != 2)
    for i, t in enumerate(texts):
        assert (t[:7].strip().encode() in known["en"]) == (zlib.crc32(str(i).encode()) % 4 != 2)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_toxicity"](spark, folder).collect()]
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    score, mark = (np.array([r[c] for r in held]) for c in ("score", "doc_id"))
    toxic = np.array([marks[i] for i in mark]) == 1
    ranks = score.argsort().argsort()
    auc = (ranks[toxic].mean() - (toxic.sum() - 1) / 2) / (~toxic).sum()
    assert auc > 0.85


def test_toxicity_edges(spark, docs_of):
    bad, good = ["you vile fool"] * 6, ["a kind word today"] * 6
    docs = docs_of([*bad, *good, None, "", "vile fool " * 50_000, "word"])
    marks = spark.createDataFrame([(i, 0, int(i < 6)) for i in range(12)] + [(13, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    weights = toxicity.learn(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, weights).collect()}
    assert all(got[i]["predicted"] == int(i < 6) for i in range(12))
    assert got[12]["score"] == got[13]["score"] and got[14]["predicted"] == 1 and got[15]["predicted"] == 0
    assert toxicity.score_toxicity(docs_of([]), weights).count() == 0
    for some in (marks.where("toxic = 1"), marks.where("doc_id < 0")):
        assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(docs, toxicity.learn(docs, some)).collect())


def test_whole_texts_teach(spark, docs_of):
    """What is toxic may stand after any number of clean characters; all is as if fitted in one place."""
    clean = "a kind word on a calm day. " * 1000
    texts = [clean + f"{i} " + ("you vile rotten fool" if i % 2 else "you dear gentle friend") for i in range(24)]
    docs = docs_of(texts)
    weights = toxicity.learn(docs, spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id bigint, toxic int"))
    assert [r["predicted"] for r in toxicity.score_toxicity(docs, weights).orderBy("doc_id").collect()] == [0, 1] * 12
    order = sorted(range(24), key=lambda i: (zlib.crc32(str(i).encode()), str(i)))
    alone = toxicity.fit([texts[i] for i in order], np.array([i % 2 for i in order]))
    assert weights.features.tolist() == alone.features.tolist() and np.allclose(weights.values, alone.values)


def plain_features(text):
    line = f" {(text or '').lower()} "
    out = set()
    for n in (3, 4, 5):
        for i in range(len(line) - n + 1):
            number = 0
            for c in line[i:i + n]:
                number = (number * 0x100000001B3 + ord(c)) % 2**64
            out.add(((number + (n << 56)) * 0x9E3779B97F4A7C15 % 2**64) >> 44)
    return out


def plain_toxicity(texts, marks, rounds=60, l2=1e-2, alpha=1.0):
    """Scores of all texts {id: text} by loops over sets; ``marks`` {id: 0 or 1}, fewer than the bound."""
    order = sorted((i for i in marks if texts.get(i) is not None), key=lambda k: (zlib.crc32(str(k).encode()), str(k)))
    held = {i: plain_features(texts[i]) for i in texts}
    y = np.array([marks[i] for i in order], float)
    toxic, other = {}, {}
    for i in order:
        for f in held[i]:
            side = toxic if marks[i] else other
            side[f] = side.get(f, 0) + 1
    size = 2**20
    sums = alpha * size + sum(toxic.values()), alpha * size + sum(other.values())
    level = np.log(((y.sum() + alpha) / sums[0]) / (((1 - y).sum() + alpha) / sums[1]))
    ratio = {f: np.log(((alpha + toxic.get(f, 0)) / sums[0]) / ((alpha + other.get(f, 0)) / sums[1])) - level
             for f in {*toxic, *other} if toxic.get(f, 0) + other.get(f, 0) >= 3}
    names = sorted(ratio)
    place = {f: n for n, f in enumerate(names)}
    rows = [[place[f] for f in held[i] if f in place] for i in order]
    scale = np.array([ratio[f] for f in names])
    w, bias, m, v = np.full(len(names), 0.1), 0.0, np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for step in range(1, rounds + 1):
        gradient = np.zeros(len(names) + 1)
        for row, label, part in zip(rows, y, balance):
            score = bias + (scale[row] * w[row]).sum()
            error = part * (1 / (1 + np.exp(-score)) - label) / len(y)
            gradient[row] += scale[row] * error
            gradient[-1] += error
        gradient[:-1] += l2 * w / len(names)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return {i: 1 / (1 + np.exp(-(bias + sum(scale[place[f]] * w[place[f]] for f in some if f in place)))) for i, some in held.items()}


def test_toxicity_is_the_plain_one(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    marks = {i: t for i, t in marks.items() if zlib.crc32(str(i).encode()) % 5 != 0}
    want = plain_toxicity(texts, marks)
    got = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, small).collect()}
    assert set(got) == set(want)
    for i, score in want.items():
        assert abs(got[i]["score"] - score) < 1e-4 and got[i]["predicted"] == int(got[i]["score"] >= 0.5)


def test_features_are_the_plain_ngrams():
    text = "Ünder, the IDIOT x" * 3
    assert set(toxicity.features(text).tolist()) == plain_features(text)
    # n-grams of characters, not of bytes: three characters of three bytes each make one.
    assert len(toxicity.features("字")) == 1 and len(toxicity.features("")) == 0
    assert set(toxicity.features("é" * 3_000_000).tolist()) == plain_features("é" * 9)


def plain_spans(t):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for k, pattern, low, high in ((2, CARD, 13, 19), (3, PHONE, 9, 15)):
        for m in pattern.finditer(t):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (k == 3 or pii.luhn(digits)):
                out.append((k, m.start(), m.end()))
    return out


def test_patterns_are_the_plain_ones():
    r = random.Random(6)
    for _ in range(4000):
        t = "".join(r.choice("a@.1 2+-()4é@.a9") for _ in range(r.randint(0, 30)))
        assert pii.base_spans(t) == plain_spans(t), t
    for t in ("1.2.3.256", "001.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999", "9" * 4000 + ".1.1.1", "a@b", "a@b.c@d.e"):
        assert pii.base_spans(t) == plain_spans(t), t
    long = "x" * 300_000 + " joe@example.org " + "1." * 100_000 + "z@"
    assert [s for s in pii.base_spans(long) if s[0] == 0] == [(0, 300_001, 300_016)]


def test_gradients_are_the_slopes():
    rng, tagger = np.random.default_rng(1), pii.Tagger.fresh(3)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    x = rng.integers(1, 100, (3, 7)).astype(np.int16)
    y = np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [1, 2, 0, 7, 8, 8, 0]])
    _, g = tagger.gradients(x, y)
    for name, place in (("E", (int(x[0, 1]), 3)), ("Wf", (2, 5)), ("Ub", (1, 29)), ("bf", (50,)), ("V", (4, 3)), ("c", (3,)), ("A", (0, 1))):
        step = 1e-2
        tagger.p[name][place] += step
        up, _ = tagger.gradients(x, y)
        tagger.p[name][place] -= 2 * step
        down, _ = tagger.gradients(x, y)
        tagger.p[name][place] += step
        assert abs((up - down) / (2 * step) - g[name][place]) < 1e-3, name


def test_model_learns_and_adds(spark, medium):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    tagger = pii.learn(docs)
    fresh = [t for t, in docs.where("doc_id % 7 = 3").select("text").collect()]
    base = [pii.base_spans(t) for t in fresh]
    found = pii.model_spans(fresh, tagger)
    n = sum(map(len, base))
    assert n > 20 and sum(s in f for b, f in zip(base, found) for s in b) / n > 0.9
    assert sum(len(f) for f in found) < 1.2 * n
    # Kinds that the patterns miss, since their neighbours spoil the match: the model adds some of them.
    spoiled = [f"{a} {b}" for t, spans in zip(fresh, base) for k, s, e in spans if k == 2 for a, b in ((t[max(0, s - 40):s] + "12", t[s:e + 40]),)]
    added = [pii.all_spans(pii.base_spans(t), f, t) for t, f in zip(spoiled, pii.model_spans(spoiled, tagger))]
    assert sum(len(a) > len(pii.base_spans(t)) for a, t in zip(added, spoiled)) > 0


def test_pii_edges(spark, docs_of):
    tagger = pii.learn(docs_of([]))
    texts = [None, "", "no digits at all", "mail joe@example.org or 10.0.0.1", "z" * 200_000 + " joe@example.org"]
    got = pii.find_pii(docs_of(texts), tagger).collect()
    assert [(r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got] == [(0, 0, 0, 0)] * 3 + [(1, 1, 0, 0), (1, 0, 0, 0)]
    assert got[3]["spans"] == "email:5:20,ip:24:32"
    assert pii.find_pii(docs_of([]), tagger).count() == 0


def test_windows_merge_into_one_path():
    tagger = pii.train(*pii.training_windows(["write to joe.smith@mail.example.com today " * 3] * 20))
    text = "x " * 40 + "joe.smith@mail.example.com" + " y" * 40  # the span crosses window edges
    (kind, start, end), = pii.model_spans([text], tagger)[0]  # one span, not one a window
    assert kind == 0 and abs(start - 80) <= 1 and end == 106


def test_training_stays_bounded_when_ids_repeat(spark, docs_of):
    """One id on most rows: equal rows teach once, and the greatest text of an id teaches."""
    texts = ["the cat and the dog ran off"] * 400 + ["der hund und die katze"] * 3
    langs = ["en"] * 400 + ["de"] * 3
    known = language.learn_dictionaries(docs_of(texts, ids=[1] * 400 + [2, 3, 4], langs=langs))
    assert known["en"].count(b"the cat") == 1 and known["de"].count(b"der hund") == 1
    docs = docs_of(["good day to you"] * 50 + ["vile awful slur"] * 50 + ["a vile slur"], ids=[1] * 50 + [2] * 51)
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, toxic int")
    weights = toxicity.learn(docs, labels)
    alone = toxicity.fit(["good day to you", "vile awful slur"], np.array([0.0, 1.0]))
    assert weights.features.tolist() == alone.features.tolist() and abs(weights.bias - alone.bias) < 1e-9


def test_number_signs_are_no_letters(spark, docs_of):
    known = {"en": b"some words here", "de": b"andere worte hier"}
    texts = ["½", "² ①", "Ⅷ 12", "٣", "ª", "é", "字", "12 ½ é"]
    got = [r["lang_pred"] == "und" for r in language.identify_language(docs_of(texts), known).orderBy("doc_id").collect()]
    assert got == [True, True, True, True, False, False, False, False]


def test_every_part_of_a_text_teaches(spark, docs_of):
    """Slices come from beginnings, middles and ends alike."""
    text = "".join(f"p{i:04d} " * 50 for i in range(400))  # 300 characters a part
    known = language.learn_dictionaries(docs_of([text]), dictionary_bytes=12_000)
    places = sorted({int(w[1:]) for w in known["en"].decode().split() if len(w) == 5})
    assert len(places) > 25 and places[0] < 60 and places[-1] > 340
    assert any(100 < p < 300 for p in places)


def plain_language(rows, train, dictionary_bytes=128_000, chars=300, block=8192, level=9):
    """{doc_id: (language, margin)} by loops: rows of (id, text, lang)."""
    import xxhash
    import zstandard

    slices = {}
    for i, text, lang in rows:
        if lang is not None and text and train(i):
            for place in range(-(-len(text) // chars)):
                seed = xxhash.xxh64_intdigest(b"language", 42)
                seed = xxhash.xxh64_intdigest(str(i).encode(), seed) if i is not None else seed
                number = xxhash.xxh64_intdigest(place.to_bytes(4, "little"), seed)
                number = number - 2**64 if number >> 63 else number
                slices.setdefault(lang, []).append((float(number) / 2.0**64 + 0.5, text[place * chars:(place + 1) * chars]))
    wanted, known = 2 * dictionary_bytes // chars, {}
    for lang, some in slices.items():
        some = sorted({s for s in some if s[0] < min(1.0, wanted / len(some))})
        content, seen = b"", set()
        for _, s in some:
            s = s.lower()
            if s in seen:
                continue
            if len(content) + len(s.encode()) + 1 > dictionary_bytes:
                break
            seen.add(s)
            content += s.encode() + b"\n"
        known[lang] = content
    out = {}
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        data, sizes = text.lower().encode(), []
        for lang, content in known.items():
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters.from_level(
                level, source_size=block, dict_size=len(content), write_content_size=False, write_dict_id=False)
            total = 0
            for at in range(0, len(data), block):
                total += len(zstandard.ZstdCompressor(dict_data=shared, compression_params=settings).compress(data[at:at + block]))
            sizes.append((total, lang))
        sizes.sort()
        out[i] = (sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0])
    return out


def test_language_is_the_plain_one(spark, small):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = plain_language(rows, lambda i: zlib.crc32(str(i).encode()) % 4 != 2)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op6_language"](spark, small).collect()}
    assert got == want and len(got) == len(rows)


def plain_model_spans(text, tagger):
    """All windows, all merged, one path over the whole text, written out."""
    n = len(text)
    if not n:
        return []
    classes = pii.char_classes(text)
    total, weights = np.zeros((n + 64, pii.N_TAGS)), np.zeros((n + 64, 1))
    weight = np.array([1 + min(i, 63 - i) for i in range(64)])[:, None]
    for start in range(0, n, 32):
        x = np.zeros((1, 64), np.int16)
        part = classes[start:start + 64]
        x[0, :len(part)] = part
        total[start:start + 64] += tagger.emissions(x)[0] * weight
        weights[start:start + 64] += weight
    e = total[:n] / weights[:n]
    anchors = [i for i, c in enumerate(text) if c in "0123456789@"]
    for i in range(n):
        if not any(abs(i - a) <= pii.REACH for a in anchors):
            e[i, 1:] = -1e4
    a = tagger.transitions().astype(float)
    score = [e[0, t] - (1e4 if t and t % 2 == 0 else 0) for t in range(pii.N_TAGS)]
    back = []
    for i in range(1, n):
        best = [max(range(pii.N_TAGS), key=lambda s: score[s] + a[s, t]) for t in range(pii.N_TAGS)]
        score = [score[best[t]] + a[best[t], t] + e[i, t] for t in range(pii.N_TAGS)]
        back.append(best)
    tags = [int(np.argmax(score))]
    for best in reversed(back):
        tags.insert(0, best[tags[0]])
    out, i = [], 0
    while i < n:
        if tags[i] % 2:
            end = i + 1
            while end < n and tags[end] == tags[i] + 1:
                end += 1
            out.append(((tags[i] - 1) // 2, i, end))
            i = end
        else:
            i += 1
    return out


def test_model_spans_are_the_plain_ones(spark):
    """Windows that are left out change nothing; neither does the order of computing."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tagger = pii.learn(docs)
    texts = [t for t, in docs.where("doc_id % 11 = 3 AND text RLIKE '[0-9@]'").select("text").limit(12).collect()]
    texts = [t[:1500] for t in texts] + ["", "none", "7", "@" * 70, "x" * 200 + "a@b.c" + "y" * 200 + " 4111111111111111", "1" * 130,
             "Call +1 (607) 555-6433 4588641552771464 now, it is all here.", "mail " + "long" * 30 + "@host.example or not"]
    want = [plain_model_spans(t, tagger) for t in texts]
    assert sum(map(len, want)) > 10
    assert pii.model_spans(texts, tagger) == want and pii.model_spans(texts, tagger, every=True) == want


def test_a_long_stretch_takes_linear_time():
    import time

    tagger = pii.Tagger.fresh(1)

    def seconds(n):
        start = time.process_time()
        pii.model_spans(["1234567890" * (n // 10)], tagger)
        return time.process_time() - start

    seconds(20_000)
    assert seconds(400_000) < 8 * seconds(100_000)


def test_spans_that_overlap_a_pattern_go():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("1234567890@.a ") for _ in range(60))
        spans = lambda n: [(rng.randrange(4), s, s + rng.randrange(1, 20)) for s in (rng.randrange(40) for _ in range(n))]
        base, found = spans(4), spans(8)
        want = [x for x in found if not any(x[1] < e and s < x[2] for _, s, e in base)
                and (pii.valid(pii.KINDS[x[0]], text[x[1]:x[2]]) if x[0] else re.search(r"\S@\S", text[x[1]:x[2]]))]
        assert pii.all_spans(base, found, text) == sorted(base + want)
