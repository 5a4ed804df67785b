"""Tokens, mixing, top-k and chat rendering."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cohortkit.llm import hamming_topk, mixing, perspectives, sentencepiece_codec
from cohortkit.llm.queries import MODEL_PATH

TEXTS = ["", " ", "  two  words \n x", "a\tb\x00c ﬁ①", "日本語テキスト 🙂", "<s> </s> <0x0A>", "a" * 20_000, "Zeit und Raum, été.", "Zeit und Raum, été."]


@pytest.fixture(scope="module")
def model():
    return sentencepiece_codec.read_model(MODEL_PATH)


def test_tokens_are_those_of_sentencepiece(spark, docs_of, model, medium):
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [None, *TEXTS, "▁a ", *[r["text"] for r in spark.read.parquet(f"{medium}/documents.parquet").limit(200).collect()]]
    got = {r["doc_id"]: r for r in sentencepiece_codec.encode_documents(docs_of(texts), model, verify_one_in=0).collect()}
    for i, t in enumerate(texts):
        assert got[i]["token_ids"] == reference.encode(t or "") and got[i]["n_tokens"] == len(got[i]["token_ids"])
        assert got[i]["round_trip"] == ("▁" not in (t or ""))
        assert got[i]["n_byte_tokens"] == sum(reference.is_byte(x) for x in got[i]["token_ids"])
    ids = sentencepiece_codec.encode_documents(docs_of(TEXTS), model)
    assert all(r["same_as_reference"] for r in ids.collect())
    back = sentencepiece_codec.decode_documents(ids, model)
    assert [r["text"] for r in back.orderBy("doc_id").collect()] == TEXTS
    assert sentencepiece_codec.encode_documents(docs_of([]), model).count() == 0


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + np.float32(value).tobytes()
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_unigram_models_are_rebuilt():
    """A small unigram model file, written field by field."""
    pieces = [("<unk>", 0.0, 2), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)],
              ("▁", -2.0, 1), ("▁ab", -1.0, 1), ("ab", -1.5, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("abab", -2.2, 1)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, 1) + field(35, 1)) + field(3, field(3, 1) + field(4, 1) + field(5, 1))
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = sentencepiece_codec.Codec(data, verify_one_in=0)
    texts = ["ab abab", "  ab   b ", "abababab é", "", "ba"]
    ids = [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)[0]]
    assert ids == [reference.encode(t) for t in texts]
    assert codec.decode([np.array(x, "<i4").tobytes() for x in ids]) == [reference.decode(x) for x in ids]


def test_every_text_is_compared():
    """sentencepiece cuts user-defined pieces out first, the rebuilt merges do not: all texts get its ids."""
    pieces = [("<unk>", 0.0, 2), ("▁", -4.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -1.0, 1), ("ba", -9.0, 4)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, 2)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab" * i + "aba" for i in range(60)] + ["a", ""]
    want = [reference.encode(t) for t in texts]
    plain, unknown = sentencepiece_codec.Codec(data, verify_one_in=0).encode(texts)
    plain = [np.frombuffer(x, "<i4").tolist() for x in plain]
    assert unknown == [None] * len(texts) and sum(p != w for p, w in zip(plain, want)) >= 50
    ids, same = sentencepiece_codec.Codec(data).encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in ids] == want
    assert same == [p == w for p, w in zip(plain, want)]
    some = sentencepiece_codec.Codec(data, verify_one_in=8).encode(texts)[1]
    assert None in some and all(s in (None, t) for s, t in zip(some, same))


WEIGHTS = {("web",): 3, ("books",): 1, ("web", "en"): 2, ("web", "fr"): 1, ("off",): 0}


def budgets(caps, weights, pot):
    """Fill siblings by weight; what one cannot take goes to the others."""
    out, open_ = {}, dict(caps)
    while open_:
        total = sum(weights[c] for c in open_)
        full = [c for c in open_ if open_[c] * total <= pot * weights[c]]
        if not full:
            out |= {c: pot * weights[c] // total for c in open_}
            break
        first = min(full, key=lambda c: (open_[c] / weights[c], c))
        out[first] = open_.pop(first)
        pot -= out[first]
    return out


def test_budgets_fill_siblings_before_ancestors(spark):
    r = random.Random(8)
    for total in (0, 1, 50, 400, 3000, 10**6):
        leaves = {(d, l, s): r.randint(0, 90) for d in ("web", "books", "off") for l in ("en", "fr") for s in ("x", "y", "z")}
        df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "level0 string, level1 string, level2 string, tokens bigint")
        got = {tuple(x[:3]): x["budget"] for x in mixing.leaf_budgets(df, 3, WEIGHTS, total, 2).collect()}
        def room(*path):
            return sum(2 * v for k, v in leaves.items() if k[:len(path)] == path)
        want = {}
        for d, pot in budgets({d: room(d) for d in ("web", "books")}, {"web": 3, "books": 1}, total).items():
            w = {"en": 2, "fr": 1} if d == "web" else {"en": 1, "fr": 1}
            for l, inner in budgets({l: room(d, l) for l in w}, w, pot).items():
                for s, b in budgets({s: room(d, l, s) for s in "xyz"}, dict.fromkeys("xyz", 1), inner).items():
                    want[d, l, s] = b
        assert got == want


def test_mix_takes_prefixes_of_seeded_passes(spark, docs_of):
    import hashlib
    r = random.Random(9)
    texts = [" ".join(["w"] * r.randint(0, 30)) for _ in range(300)]
    sources = [r.choice(["a", "b", None]) for _ in texts]
    docs = docs_of(texts, sources=sources)
    for share, epochs in ((0.3, 1), (1.7, 3), (5.0, 2), (0.0, 2)):
        got = {x["doc_id"]: x["epochs"] for x in mixing.mix(docs, [F.col("source")], {("a",): 1, ("b",): 5}, share, max_epochs=epochs, seed=4).collect()}
        size = {s: sum(len(t.split()) for t, o in zip(texts, sources) if o == s) for s in ("a", "b", None)}
        pots = budgets({str(s): n * epochs for s, n in size.items()}, {"a": 1, "b": 5, "None": 1}, int(sum(size.values()) * int(share * 1_000_000) // 1_000_000))
        want = {}
        for s, n in size.items():
            whole, rest = divmod(pots[str(s)], n)
            order = sorted((hashlib.md5(f"4|{whole}|{i}".encode()).hexdigest(), i) for i, o in enumerate(sources) if o == s)
            upto = 0
            for _, i in order:
                upto += len(texts[i].split())
                if whole + (upto <= rest):
                    want[i] = whole + (upto <= rest)
        assert got == want
        rows = mixing.mixed_documents(docs, [F.col("source")], {("a",): 1, ("b",): 5}, share, max_epochs=epochs, seed=4)
        assert rows.columns == docs.columns and sorted(x["doc_id"] for x in rows.collect()) == sorted(i for i, n in want.items() for _ in range(n))


def test_mix_edges(spark, docs_of):
    assert mixing.mix(docs_of([]), [F.col("source")], {}).count() == 0
    got = mixing.mix(docs_of([None, "", "a b"], sources=["z", "z", "y"], ids=[None, 1, 1]), [F.col("source")], {}, max_epochs=2, budget_share=2.0)
    assert sorted((x["level0"], x["tokens"], x["epochs"]) for x in got.collect()) == [("y", 2, 2), ("z", 0, 2), ("z", 0, 2)]


def test_top_k_is_brute_force(spark):
    rng = np.random.default_rng(12)
    codes = rng.integers(-2**63, 2**63, 300)
    codes[:90] = codes[0]  # one code holds almost a third of the rows
    codes[90:150] = codes[90] ^ (np.int64(1) << rng.integers(0, 63, 60))
    rows = [(i, int(c)) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows + rows[:5] + [(None, 1), (500, None)], "id bigint, code bigint")
    want = set()
    for q in range(0, 300, 7):
        far = sorted((int(np.bitwise_count(np.uint64(codes[q].view(np.uint64) ^ codes[i].view(np.uint64)))), i) for i in range(300) if i != q)
        want |= {(q, n + 1, i, d) for n, (d, i) in enumerate(far[:9])}
    for block, asked in ((16_384, 4096), (40, 10)):
        got = hamming_topk.top_k(df, F.col("id") % 7 == 0, 9, block, asked)
        assert {tuple(x) for x in got.collect()} == want and got.count() == len(want)
    assert hamming_topk.top_k(df.limit(0), F.col("id") % 7 == 0).count() == 0
    assert hamming_topk.top_k(df.where("id = 0"), F.col("id") % 7 == 0).count() == 0


def test_sign_codes(spark):
    rows = [(1, [1.0, -1.0, 0.0, None]), (2, None), (3, []), (None, [1.0]), (4, [1.0] * 70)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id int, embedding array<float>, code int")
    assert sorted(tuple(r) for r in hamming_topk.sign_codes(df).collect()) == [(1, 0b101), (3, 0), (4, -1)]


def chat(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")


def test_every_speaker_has_a_perspective(spark):
    rows = [(1, 0, "system", "Be kind"), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "b b", "Yo"), (1, 3, "ann", None)]
    got = {r["perspective"]: r for r in perspectives.render_perspectives(chat(spark, rows)).collect()}
    assert set(got) == {"ann", "b b"}
    assert got["b b"]["text"] == (
        "<|im_start|>system\nBe kind<|im_end|>\n<|im_start|>user name=ann\nHi <|_im_end|><|im_end|>\n"
        "<|im_start|>assistant\nYo<|im_end|>\n<|im_start|>user name=ann\n<|im_end|>\n")
    for r in got.values():
        spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",")]
        assert [r["text"][a:b] for a, b in spans] == (["Yo<|im_end|>"] if r["perspective"] == "b b" else ["Hi <|_im_end|><|im_end|>", "<|im_end|>"])
        assert r["n_turns"] == 4 and r["n_own_turns"] == len(spans)


def test_long_dialogues_come_in_parts(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i} é") for i in range(150)]
    got = perspectives.render_perspectives(chat(spark, rows), 32).where("perspective = 'a'").orderBy("part").collect()
    assert [r["part"] for r in got] == [0, 1, 2, 3, 4]
    whole = perspectives.render_perspectives(chat(spark, rows), 1000).where("perspective = 'a'").first()
    assert "".join(r["text"] for r in got) == whole["text"]
    assert sum(r["n_own_turns"] for r in got) == whole["n_own_turns"] == 75


def test_chat_edges(spark):
    rows = [(None, 1, "a", "x"), (None, 2, None, "y"), (2, None, "a", "loose"), (2, 0, "a", "first"), (2, 0, "a", "first"), (3, 0, "system", "only")]
    got = [r for r in perspectives.render_perspectives(chat(spark, rows)).collect()]
    assert sorted((r["conv_id"] or 0, r["part"] < 0, r["n_turns"]) for r in got) == [(0, False, 2), (2, False, 2), (2, True, 1)]
    assert perspectives.render_perspectives(chat(spark, [])).count() == 0


def test_over_full_parts_come_in_chunks(spark):
    """A third of the rows without a dialogue id and a turn that repeats: nothing is lost or doubled."""
    rows = [(None, i % 3, "ab"[i % 2], f"t{i}") for i in range(90)] + [(7, 0, "a", "same")] * 100 + [(8, i, "ab"[i % 2], "x") for i in range(20)]
    got = perspectives.render_perspectives(chat(spark, rows), part_rows=25).where("perspective = 'a'").collect()
    by = {k: [r for r in got if r["conv_id"] == k] for k in (None, 7, 8)}
    assert {k: sum(r["n_turns"] for r in v) for k, v in by.items()} == {None: 90, 7: 100, 8: 20}
    assert len(by[None]) > 1 and len(by[7]) > 1 and [r["chunk"] for r in by[8]] == [0]
    assert sorted(w for r in by[None] for w in r["text"].split() if w.startswith("t")) == sorted(f"t{i}<|im_end|>" for i in range(90))
    assert all(r["text"].count("same<|im_end|>") == r["n_turns"] == r["n_own_turns"] for r in by[7])
    for r in got:
        spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",") if s]
        assert len(spans) == r["n_own_turns"] and all(r["text"][a:b].endswith("<|im_end|>") for a, b in spans)


def test_chunks_in_order_are_the_dialogue(spark, monkeypatch):
    """Over-full parts, also of rows without a turn or a dialogue id, are cut in the order of the dialogue."""
    r = random.Random(3)
    rows = [(None, i % 5, "ab"[i % 2], f"t{i}") for i in range(200)] + [(7, 70, "a", "same")] * 60 + [(7, 70, "b", f"u{i}") for i in range(50)]
    rows += [(7, 71, None, "x")] * 3 + [(8, None, "abc"[i % 3], f"loose {i}") for i in range(10)] + [(8, -1, "a", "early"), (8, 0, "b", "first")]
    rows += [(9, None, "ab"[i % 2], f"v{i % 70}") for i in range(90)]
    r.shuffle(rows)

    def texts(part_rows):
        got = perspectives.render_perspectives(chat(spark, rows), part_rows=part_rows).orderBy("part", "chunk").collect()
        out = {}
        for x in got:
            out.setdefault((x["conv_id"], x["perspective"]), []).append(x)
        return out

    whole = texts(1000)
    assert {k: len(v) for k, v in whole.items()} == {
        (None, "a"): 1, (None, "b"): 1, (7, "a"): 1, (7, "b"): 1, (8, "a"): 3, (8, "b"): 3, (8, "c"): 3, (9, "a"): 1, (9, "b"): 1}
    for range_rows in (1 << 16, 20):
        monkeypatch.setattr(perspectives, "_RANGE_ROWS", range_rows)
        cut = texts(25)
        assert {k: "".join(x["text"] for x in v) for k, v in cut.items()} == {k: "".join(x["text"] for x in v) for k, v in whole.items()}
        assert [x["n_turns"] for x in cut[7, "a"]] == [25, 25, 25, 25, 13] and [x["chunk"] for x in cut[7, "a"]] == [0, 1, 2, 3, 4]
        assert [x["n_turns"] for x in cut[8, "c"]] == [10, 1, 1]


def test_words_are_compared_where_they_stand_alone():
    """The ids of a text are those of its words, also in several threads and with a small cache; a word
    that the libraries encode differently marks each text that holds it."""
    pieces = [("<unk>", 0.0, 2), ("▁", -4.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -1.0, 1), ("ba", -9.0, 4), ("▁a", -2.0, 1)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, 2)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    r = random.Random(5)
    texts = ["".join(r.choice("aab  ") for _ in range(r.randint(0, 12))) for _ in range(300)] + ["▁a ▁", " ", "", "é a"]
    for threads in (1, 3):
        codec = sentencepiece_codec.Codec(data, threads=threads)
        assert codec.words_compared
        ids, same = codec.encode(texts)
        assert [np.frombuffer(x, "<i4").tolist() for x in ids] == [reference.encode(t) for t in texts]
        assert all(s == ("aba" not in t and "bab" not in t) or not s for s, t in zip(same, texts)) and False in same and True in same
    # A user-defined piece over a marker: no cutting into words, whole texts are compared.
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in [*pieces, ("a▁", 0.0, 4)])
    data += field(2, field(3, 2)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    codec, reference = sentencepiece_codec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert not codec.by_word and not codec.words_compared
    assert [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)[0]] == [reference.encode(t) for t in texts]


def test_mix_of_repeated_ids_and_narrow_ranges(spark, docs_of, monkeypatch):
    """A third of the rows without an id, many of one id, long texts: the same at any range size."""
    r = random.Random(10)
    texts = [" ".join(["w"] * r.randint(0, 9)) for _ in range(600)] + ["long " * 60_000, None, ""]
    ids = [None if i % 3 == 0 else 7 if i % 5 == 0 else i for i in range(len(texts))]
    sources = [r.choice(["a", "b"]) for _ in texts]
    docs = docs_of(texts, ids=ids, sources=sources)

    def taken(share):
        got = mixing.mix(docs, [F.col("source")], {("a",): 2}, share, max_epochs=2, seed=1).collect()
        return sorted((x["level0"], str(x["doc_id"]), x["tokens"], x["epochs"]) for x in got)

    want = {share: taken(share) for share in (0.2, 0.8)}
    for share, rows in want.items():
        # Rows of one id and leaf are taken equally often, and budgets are kept.
        for key in {(s, i) for s, i, _, _ in rows}:
            assert len({e for s, i, _, e in rows if (s, i) == key}) == 1
        size = sum(len((t or "").split()) for t in texts)
        assert sum(t * e for _, _, t, e in rows) <= share * size
    monkeypatch.setattr(mixing, "RANGE_DIGITS", 1)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert {share: taken(share) for share in want} == want
