"""The registered queries of this subpackage, and SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortkit.llm import (
    hamming_topk, hard_negatives, language, lexical, mixing, perspectives, pii, repeats, sentencepiece_codec, simhash, toxicity, wrapper)
from cohortkit.llm.common import id_remainder, table
from cohortkit.llm.digest_index import DigestIndex
from cohortkit.session import at_end, shared_folder

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
ENCODING_THREADS = 2
DOMAIN = ("CASE WHEN source = 'src0' THEN 'web' WHEN source IN ('src1', 'src2', 'src3', 'src4', 'src5', 'src6') "
          "THEN 'books' ELSE 'reference' END")
WEIGHTS = {
    ("web",): 5, ("books",): 3, ("reference",): 2,
    **{(d, lang): w for d in ("web", "books", "reference") for lang, w in (("en", 6), ("fr", 2), ("de", 2), ("es", 1))},
}
MIXTURE = {"budget_share": 0.8, "max_epochs": 2, "seed": 17}
DEDUP_BATCHES = 2
QUERY_EVERY = 50
NEIGHBOURS = 10
ANCHOR_EVERY = 100


def levels():
    return [F.expr(DOMAIN), F.col("lang"), F.col("source")]


def language_rule():
    """Rows that may teach languages."""
    return id_remainder("doc_id", 4) != 2


def new_index(spark) -> DigestIndex:
    """An empty index; a job of ``scratch`` takes it along when it ends."""
    index = DigestIndex(spark, f"{shared_folder(spark)}/cohortkit-digests-{uuid.uuid4().hex}")
    at_end(index.drop)
    return index


def op1_sentencepiece(spark, folder):
    model = sentencepiece_codec.read_model(MODEL_PATH)
    return sentencepiece_codec.encode_documents(table(spark, folder, "documents"), model, threads=ENCODING_THREADS)


def op2_repeats(spark, folder):
    return repeats.remove_repeats(table(spark, folder, "documents"))


def op3_mixing(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"), levels(), WEIGHTS, **MIXTURE)
    return mixed.withColumnsRenamed({"level0": "domain", "level1": "lang", "level2": "source"})


def op4_topk(spark, folder):
    codes = hamming_topk.sign_codes(table(spark, folder, "embeddings"))
    return hamming_topk.top_k(codes, F.col("id") % QUERY_EVERY == 0, NEIGHBOURS)


def op5_perspectives(spark, folder):
    return perspectives.render_perspectives(table(spark, folder, "conversations"))


def op6_language(spark, folder):
    docs = table(spark, folder, "documents")
    found = language.identify_language(docs, language.learn_dictionaries(docs, language_rule()))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    weights = toxicity.learn(docs, table(spark, folder, "labels"), id_remainder("doc_id", 5) != 0)
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    return toxicity.score_toxicity(docs, weights).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_exact_dedup(spark, folder):
    return new_index(spark).add_from_largest(table(spark, folder, "documents"), DEDUP_BATCHES)


def op9_pii(spark, folder):
    docs = table(spark, folder, "documents")
    return pii.find_pii(docs, pii.learn(docs))


def op10_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op11_hard_negatives(spark, folder):
    label = F.expr("CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    rows = hard_negatives.quantised(table(spark, folder, "embeddings"), label=label)
    return hard_negatives.hard_negatives(rows, F.col("id") % ANCHOR_EVERY == 0)


def op12_lexical_search(spark, folder):
    return lexical.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_main_text(spark, folder):
    return wrapper.extract_text(table(spark, folder, "pages"))


OP2_SQL = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sections AS (
  SELECT doc_id, o, substr(h, 2 * o + 1, 2098) AS part
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49, 1000)) AS o FROM docs WHERE length(h) >= 100)),
windows AS (
  SELECT doc_id, o + unnest(range(0, length(part) // 2 - 49)) AS s,
    unnest(list_transform(range(0, length(part) // 2 - 49), lambda s: md5_number(substr(part, 2 * s + 1, 100)))) AS w
  FROM sections),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, s FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
marked AS (SELECT doc_id, s, s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, -1) AS opens FROM hits),
numbered AS (SELECT doc_id, s, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS upto FROM runs),
kept AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, CAST(count(*) AS BIGINT) AS n_spans, max(b) AS tail,
    string_agg(substr(h, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS front
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN front IS NULL THEN h ELSE front || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def _mixing_sql() -> str:
    weight = {
        n: "CASE " + " ".join(
            "WHEN " + " AND ".join(f"level{i} = '{p}'" for i, p in enumerate(key)) + f" THEN {w}"
            for key, w in WEIGHTS.items() if len(key) == n + 1) + " ELSE 1 END" if n < 2 else "1"
        for n in range(3)
    }
    share = int(MIXTURE["budget_share"] * 1_000_000)
    parts = [f"""docs AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens,
    {DOMAIN} AS level0, lang AS level1, source AS level2 FROM documents),
leaves AS (SELECT level0, level1, level2, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {MIXTURE["max_epochs"]} AS room
  FROM docs GROUP BY ALL),
total AS (SELECT sum(tokens)::HUGEINT * {share} // 1000000 AS pot FROM leaves)"""]
    for n in range(3):
        path = ", ".join(f"level{i}" for i in range(n + 1))
        above = ", ".join(f"level{i}" for i in range(n))
        by = f"PARTITION BY {above} " if above else ""
        order = f"{by}ORDER BY room::DOUBLE / weight::DOUBLE, level{n} NULLS FIRST"
        source = f"c{n}, total" if n == 0 else f"c{n} JOIN (SELECT {above}, budget AS pot FROM b{n - 1}) USING ({above})"
        parts.append(f"""c{n} AS (SELECT {path}, sum(room)::HUGEINT AS room, ({weight[n]})::HUGEINT AS weight FROM leaves GROUP BY {path}),
w{n} AS (SELECT {path}, room, weight, pot,
    pot - coalesce(sum(room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pot_left,
    sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM {source}),
f{n} AS (SELECT *, room * weight_left <= pot_left * weight AS fills FROM w{n}),
r{n} AS (SELECT *, max(CASE WHEN NOT fills THEN weight_left END) OVER ({by}) AS rest_weight FROM f{n}),
q{n} AS (SELECT *, max(CASE WHEN NOT fills AND weight_left = rest_weight THEN pot_left END) OVER ({by}) AS rest_pot FROM r{n}),
b{n} AS (SELECT {path}, CASE WHEN fills THEN room ELSE rest_pot * weight // rest_weight END AS budget FROM q{n})""")
    parts.append(f"""passes AS (SELECT level0, level1, level2,
    CASE WHEN tokens > 0 THEN budget // tokens ELSE {MIXTURE["max_epochs"]} END::BIGINT AS whole,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM leaves JOIN b2 USING (level0, level1, level2)),
drawn AS (SELECT *, md5(concat_ws('|', '{MIXTURE["seed"]}', whole, doc_id)) AS draw FROM docs JOIN passes USING (level0, level1, level2)),
upto AS (SELECT *, sum(tokens) OVER (PARTITION BY level0, level1, level2 ORDER BY draw) AS running FROM drawn)""")
    return "WITH " + ",\n".join(parts) + """
SELECT doc_id, level0 AS domain, level1 AS lang, level2 AS source, tokens, whole + (running <= rest)::BIGINT AS epochs
FROM upto WHERE whole + (running <= rest)::BIGINT > 0"""


OP4_SQL = f"""
WITH q AS (SELECT vec_id AS query_id, embedding AS qv FROM embeddings WHERE vec_id % {QUERY_EVERY} = 0),
d AS (SELECT query_id, vec_id AS id,
    list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (qv[i] >= 0) <> (embedding[i] >= 0) THEN 1 ELSE 0 END))::BIGINT AS distance
  FROM q, embeddings WHERE vec_id <> query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
SELECT query_id, rank, id, distance FROM r WHERE rank <= {NEIGHBOURS}"""

# No part of the given tables is over-full, so chunk is 0; tests/llm has parts that are.
OP5_SQL = f"""
WITH t AS (SELECT conv_id, turn, role, CAST(floor(turn / {perspectives.PART_TURNS}.0) AS BIGINT) AS part,
    replace(coalesce(text, ''), '<|im_', '<|_im_') AS content FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> '{perspectives.SYSTEM}'),
p AS (SELECT *, coalesce(role = perspective, false) AS own,
    '{perspectives.START}' || CASE WHEN role = perspective THEN 'assistant' WHEN role = '{perspectives.SYSTEM}' THEN role
      WHEN role IS NULL THEN 'user' ELSE 'user name=' || regexp_replace(role, '[^A-Za-z0-9_-]', '_', 'g') END || chr(10) AS head,
    content || '{perspectives.END}' AS tail FROM t JOIN s USING (conv_id)),
o AS (SELECT *, sum(length(head) + length(tail) + 1) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY turn, role, content ROWS UNBOUNDED PRECEDING) AS upto FROM p)
SELECT conv_id, perspective, part, CAST(0 AS BIGINT) AS chunk, count(*) AS n_turns, count(*) FILTER (own) AS n_own_turns,
  string_agg(head || tail || chr(10), '' ORDER BY turn, role, content) AS text,
  coalesce(string_agg((upto - length(tail) - 1)::BIGINT || ':' || (upto - 1)::BIGINT, ',' ORDER BY turn, role, content) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, perspective, part"""

OP8_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""

OP11_SQL = f"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM v a, v b WHERE a.id % {ANCHOR_EVERY} = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
    id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10"""

OP12_SQL = """
WITH t AS (SELECT rowid AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
d AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY r, doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, docs),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN d USING (r), c GROUP BY item_id, doc_id, r),
n AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM n WHERE rank <= 50"""

QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_repeats, op3_mixing, op4_topk, op5_perspectives, op6_language, op7_toxicity,
    op8_exact_dedup, op9_pii, op10_simhash, op11_hard_negatives, op12_lexical_search, op13_main_text)}
SQL = {"op2_repeats": OP2_SQL, "op3_mixing": _mixing_sql(), "op4_topk": OP4_SQL, "op5_perspectives": OP5_SQL,
       "op8_exact_dedup": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op12_lexical_search": OP12_SQL}
