"""Language identification by compression.

One zstandard dictionary of raw text per language; a text belongs to the language whose
dictionary makes it smallest, and is rejected when the runner-up is about as small.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.llm.common import release_memory, rows_of

# Bound of the training sample and its unit, and how texts are compressed.
DICTIONARY_BYTES = 128_000
SLICE_CHARS = 300
BLOCK_BYTES = 8192
LEVEL = 9
MIN_MARGIN = 0.002
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]").search


def has_letter(text: str) -> bool:
    """A character of Unicode's letter categories; number signs such as ½ or Ⅷ are none."""
    return bool(_ASCII_LETTER(text)) or any(map(str.isalpha, text))


def learn_dictionaries(
    docs: DataFrame, train: Column | None = None, dictionary_bytes: int = DICTIONARY_BYTES,
    slice_chars: int = SLICE_CHARS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> dict[str, bytes]:
    """Raw dictionary content by language, from a bounded sample of labelled rows.

    Whole texts are cut into slices of ``slice_chars`` characters, and of all slices of a
    language those with the smallest hashes of (id, place) are taken, lower-cased and without
    repeats, until ``dictionary_bytes`` are filled: every part of every text has the same chance.
    Rows with a NULL language or text, and rows that ``train`` excludes, teach nothing. The
    driver sees one count and at most about two dictionaries' worth of slices a language.
    """
    if train is not None:
        docs = docs.where(train)
    rows = rows_of(docs, doc_id=id_col, text=text_col, lang=lang_col).where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    wanted = 2 * dictionary_bytes // slice_chars
    rows = rows.withColumn("n", F.ceil(F.length("text") / slice_chars).cast("int"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        return {}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, wanted / n))).otherwise(share)

    def draw(place: Column) -> Column:
        """A hash in [0, 1); slices below the language's share are about `wanted` many."""
        return F.xxhash64(F.lit("language"), F.col("doc_id").cast("string"), place).cast("double") / 2.0**64 + 0.5

    # Only places are looked at until a slice is taken.
    places = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: draw(i) < F.col("share"))
    taken = rows.withColumn("share", share).select("lang", "doc_id", "text", F.explode(places).alias("place"))
    found: dict[str, list[tuple[float, str]]] = {}
    # An id may be repeated any number of times: equal slices count once, and the bound holds.
    drawn = taken.select("lang", draw(F.col("place")).alias("draw"), F.col("text").substr(
        F.col("place") * slice_chars + 1, F.lit(slice_chars)).alias("slice")).distinct()
    for r in drawn.orderBy("draw", "lang", "slice").limit(2 * wanted * len(counts)).collect():
        found.setdefault(r["lang"], []).append((r["draw"], r["slice"].lower()))
    dictionaries = {}
    for lang, slices in found.items():
        kept, size = [], 0
        for text in dict.fromkeys(s for _, s in sorted(slices)):
            data = text.encode("utf-8", "surrogatepass") + b"\n"
            if size + len(data) > dictionary_bytes:
                break
            kept.append(data)
            size += len(data)
        if kept:
            dictionaries[lang] = b"".join(kept)
    return dictionaries


class CompressionClassifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, block_bytes: int = BLOCK_BYTES):
        self.block, self.compressors = block_bytes, []
        for lang in sorted(dictionaries):
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters.from_level(
                level, source_size=block_bytes, dict_size=len(dictionaries[lang]),
                write_content_size=False, write_dict_id=False)
            self.compressors.append((lang, zstandard.ZstdCompressor(dict_data=content, compression_params=settings).compress))

    def classify(self, text: str | None) -> tuple[str, float]:
        """(language, margin): margin is how much smaller the best is than the runner-up."""
        if not text or not self.compressors or not has_letter(text):
            return UNKNOWN, 0.0
        data = text.lower().encode("utf-8", "surrogatepass")
        blocks = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        sizes = sorted((sum(len(compress(b)) for b in blocks), lang) for lang, compress in self.compressors)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def identify_language(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Adds nothing but decisions: doc_id, lang_pred, score (the margin, 0 to 1), rejected.

    A letter is a character of Unicode's categories L*. Whole texts are compressed in blocks against each dictionary and the sizes summed. A
    text that is NULL or has no letter is ``und`` with score 0 and rejected; a text whose
    margin is below ``min_margin`` keeps its language (the first by name of equal ones)
    but is rejected. Without dictionaries every text is ``und``. Repeated rows come back
    repeated, an empty table gives no rows.

    One pass without a shuffle; the dictionaries (DICTIONARY_BYTES each) are broadcast.
    """
    rows = rows_of(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(
        _classify(docs.sparkSession.sparkContext.broadcast(dictionaries), min_margin, ["doc_id"]),
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def filter_language(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that ``identify_language`` does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        classifier = CompressionClassifier(shared.value)
        for batch in batches:
            found = [classifier.classify(t.as_py()) for t in batch[text_col]]
            keep = [lang != UNKNOWN and margin >= min_margin for lang, margin in found]
            yield batch.filter(pa.array(keep, pa.bool_()))
        del classifier
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def _classify(shared, min_margin: float, carried: list[str]):
    def run(batches):
        classifier = CompressionClassifier(shared.value)
        for batch in batches:
            found = [classifier.classify(t.as_py()) for t in batch["text"]]
            rejected = [lang == UNKNOWN or margin < min_margin for lang, margin in found]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in carried]
                + [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                   pa.array(rejected, pa.bool_())],
                [*carried, "lang_pred", "score", "rejected"])
        del classifier
        release_memory()

    return run
