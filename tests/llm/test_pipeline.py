"""The pipeline against each of its stages in plain Python, and on odd rows."""

import hashlib

import sentencepiece
from test_duplicates import LOWER, components, plain_fingerprint
from test_models import plain_language
from test_others import budgets

import corpus_pipeline
from cohortkit.llm import language, sentencepiece_codec
from cohortkit.llm.queries import MIXTURE, MODEL_PATH, WEIGHTS

STAGE = dict(corpus_pipeline.STAGES)


def plain_mixture(rows):
    """Rows (id, text, lang, source), each as often as it is taken."""
    def domain(source):
        return "web" if source == "src0" else "books" if source in {f"src{i}" for i in range(1, 7)} else "reference"

    size = {r: len((r[1] or "").encode().split()) for r in rows}
    path = {r: (domain(r[3]), r[2], r[3]) for r in rows}
    leaves = {}
    for r in rows:
        leaves.setdefault(path[r], []).append(r)
    room = lambda *p: sum(2 * size[r] for r in rows if path[r][:len(p)] == p)
    left = {}

    def share(above, pot):
        names = {p[len(above)] for p in leaves if p[:len(above)] == above}
        weights = {n: WEIGHTS.get((*above, n), 1) for n in names}
        for n, b in budgets({n: room(*above, n) for n in names}, weights, pot).items():
            if len(above) == 2:
                left[(*above, n)] = b
            else:
                share((*above, n), b)

    share((), sum(size.values()) * int(MIXTURE["budget_share"] * 1_000_000) // 1_000_000)
    out = []
    for leaf, members in leaves.items():
        tokens = sum(size[r] for r in members)
        whole, rest = divmod(left[leaf], tokens) if tokens else (MIXTURE["max_epochs"], 0)
        upto = 0
        for _, r in sorted((hashlib.md5(f"{MIXTURE['seed']}|{whole}|{r[0]}".encode()).hexdigest(), r) for r in members):
            upto += size[r]
            out += [r] * (whole + (upto <= rest))
    return out


def test_run_is_the_plain_pipeline(spark, small):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    import zlib

    found = plain_language([r[:3] for r in rows], lambda i: zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [r for r in rows if found[r[0]][0] != "und" and found[r[0]][1] >= language.MIN_MARGIN]
    last = {}
    for r in rows:
        key = r[1].translate(LOWER)
        last[key] = max(last.get(key, r), r)
    rows = list(last.values())
    ids, fps = [r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows]
    first = set(components(ids, fps))
    rows = [r for r in rows if r[0] in first]
    rows = plain_mixture(rows)
    reference = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    want = sorted((r[0], reference.encode(r[1])) for r in rows)
    got = corpus_pipeline.run(spark, small).collect()
    assert sorted((r["doc_id"], r["token_ids"]) for r in got) == want and len(want) > 50
    for r in got:
        assert r["n_tokens"] == len(r["token_ids"]) and r["same_as_reference"] and r["round_trip"]
        assert r["ids_sha256"] == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in r["token_ids"])).hexdigest()


def odd_documents(spark):
    words = "the cat and the dog ran off to see what the others had found there "
    german = "der hund und die katze liefen weg um zu sehen was die anderen dort fanden "
    texts = [None, "", "12 ½ !", words, words.upper(), words, german * 3, german * 3 + "ende", words * 18_000, "\x00 " + words, "é" * 300] + [
        f"{words if i % 2 else german} number {i} of many {'x' * i}" for i in range(40)]
    ids = [None, 1, 1, 5, 5, None, None, 8, 9, 9, 2**40, *range(100, 140)]
    rows = [(ids[i], t, ("en", "de", None)[i % 3], ("src0", "src1", None, "other")[i % 4], None if t is None else len(t), i, "d", -1.5)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` int, `draw` string, `level0` double")


def test_odd_rows_pass_all_stages(spark, small):
    docs = odd_documents(spark)
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(after.collect(), after.schema)
        counts.append(docs.count())
        if name == "language_id":
            left = {r["text"] for r in docs.collect()}
            assert None not in left and "" not in left and "12 ½ !" not in left
        if name == "exact_dedup":
            texts = [r["text"].translate(LOWER) for r in docs.collect()]
            assert len(texts) == len(set(texts))
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0 and counts[4] > 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert encoded.count() == counts[4] and encoded.where("same_as_reference AND round_trip").count() == counts[4]


def test_an_empty_table_passes_all_stages(spark, small):
    docs = odd_documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0, name
        docs = spark.createDataFrame([], docs.schema)


def test_stage_order():
    assert list(STAGE) == ["language_id", "exact_dedup", "simhash_dedup", "mixing", "sentencepiece"]
    assert sentencepiece_codec.read_model(MODEL_PATH)
