"""SentencePiece models run by the tokenizers library, checked against sentencepiece.

The model file is read as plain protobuf fields; normaliser, metaspace marker, piece
scores and byte fallback are rebuilt as a tokenizers pipeline. Unigram models keep their
scores; of BPE models the merges follow from the scores (a merge for every way to put a
piece together, best score first).
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import struct
import zlib
from array import array
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cohortkit.llm.common import release_memory, rows_of

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
# Field numbers of the published model format: ModelProto 1 pieces, 2 trainer, 3 normalizer.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Texts go to the library in batches of about this many characters.
BATCH_CHARS = 1_000_000
# Words whose ids a task remembers (some 200 bytes each).
KNOWN_WORDS = 300_000


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def _fields(data: bytes):
    """(number, value) of the fields of one protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, data[at:at + size]
            at += size
        elif tag & 7 in (1, 5):
            size = 8 if tag & 7 == 1 else 4
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            raise ValueError("not a SentencePiece model")


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append(piece)
            model.scores.append(score)
            model.kinds.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.model_type = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            names = {3: "add_dummy_prefix", 4: "remove_extra_whitespaces", 5: "escape_whitespaces"}
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n in names:
                    setattr(model, names[n], bool(v))
    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Every way to put a normal piece together from two others, best score first."""
    usable = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k in (NORMAL, USER_DEFINED)}
    rank = {p: i for i, p in enumerate(model.pieces)}
    found = []
    for piece, score in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-score, rank[piece], rank[left], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model):
    """The model as a tokenizers pipeline."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = model.kinds.index(UNKNOWN)
    if model.model_type == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), unknown, model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, p in enumerate(model.pieces)}, merges(model), unk_token=model.pieces[unknown],
            fuse_unk=True, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    if not any(re.search(f"[^{MARK}]{MARK}", p) for p, k in zip(model.pieces, model.kinds) if k in (NORMAL, USER_DEFINED, UNUSED)):
        # No piece reaches over a marker, so words can be cut apart (and are cached).
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    # The space of the dummy prefix is taken off where whole texts are put together.
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class Codec:
    """Encodes and decodes batches; where the two libraries differ, sentencepiece's ids win.

    If no piece reaches over a metaspace marker, the ids of a text are those of its words
    one after the other, in both libraries; then only words not seen lately are encoded.
    Batches to encode are spread over ``threads`` threads (the library works without Python's lock).

    Everything is compared with sentencepiece: each different word when it enters the
    cache, if the model leaves characters as they are (so that a word can be given to
    sentencepiece alone), else each whole text. With ``verify_one_in`` above 1 only every so many-th
    text is compared, as a whole (chosen by its crc32), with 0 none.
    """

    def __init__(self, model_bytes: bytes, verify_one_in: int = 1, threads: int = 1, known_words: int = KNOWN_WORDS):
        # The library's own thread pool costs twice the CPU time on small batches.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.model = parse_model(model_bytes)
        self.fast = build_tokenizer(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
        self.verify_one_in = verify_one_in
        self.byte_ids = np.array([k == BYTE for k in self.model.kinds])
        self.normalizer, self.words = self.fast.normalizer, {}
        self.by_word = self.fast.pre_tokenizer is not None
        if self.by_word:  # texts are normalised and cut here
            self.fast.normalizer = self.fast.pre_tokenizer = None
        model = self.model
        plain = model.add_dummy_prefix and model.escape_whitespaces and not model.charsmap and not model.remove_extra_whitespaces
        self.words_compared = verify_one_in == 1 and self.by_word and plain and MARK in model.pieces
        self.other: set[str] = set()
        self.odd: dict[str, str] = {}
        self.pool, self.threads, self.known_words = ThreadPoolExecutor(threads), threads, known_words

    def _spread(self, function, items: list) -> list:
        if self.threads == 1 or len(items) < 16 * self.threads:
            return list(function(items))
        step = -(-len(items) // self.threads)
        parts = [items[i:i + step] for i in range(0, len(items), step)]
        return [x for part in self.pool.map(function, parts) for x in part]

    def _normal(self, text: str) -> str:
        if not text:
            return ""
        if self.model.charsmap or self.model.remove_extra_whitespaces:
            return self.normalizer.normalize_str(text) if self.normalizer else text
        if self.model.escape_whitespaces:
            text = text.replace(" ", MARK)
        return MARK + text if self.model.add_dummy_prefix else text

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool | None]]:
        """(ids as little-endian 32-bit numbers, whether both libraries gave the same ids;
        None where they were not compared)."""
        return self.encode_and_decode(texts, False)[:2]

    def encode_and_decode(self, texts: list[str], back: bool = True) -> tuple[list[bytes], list[bool | None], list[str]]:
        """:meth:`encode`, and (``back``) what :meth:`decode` makes of the ids."""
        if self.words_compared:
            return self._by_words(texts, back)
        if self.by_word:
            split = [_WORDS(self._normal(t)) for t in texts]
            new = self._new_words(split)
            self.words.update(zip(new, self._encoded(new)))
            ids = [b"".join(map(self.words.__getitem__, words)) for words in split]
        else:
            ids = self._encoded(texts)
        same: list[bool | None] = [None] * len(texts)
        if self.verify_one_in:
            n = self.verify_one_in
            asked = [i for i, t in enumerate(texts) if n == 1 or zlib.crc32(t.encode()) % n == 0]
            for i, want in zip(asked, self._by_reference([texts[i] for i in asked])):
                same[i], ids[i] = ids[i] == want, want
        return ids, same, self.decode(ids) if back else []

    def _by_words(self, texts: list[str], back: bool) -> tuple[list[bytes], list[bool | None], list[str]]:
        """Ids and texts put together from those of words, known without their first marker.

        Each new word is encoded by both libraries and decoded again: ``other`` has the words that
        they encode differently, ``odd`` those that do not come back as they were.
        """
        split = []
        for t in texts:
            simple = t and MARK not in t and "  " not in t and t[0] != " " and t[-1] != " "
            split.append(t.split(" ") if simple else [w[1:] for w in _WORDS(self._normal(t))])
        new = self._new_words(split)
        found, wanted = self._encoded([MARK + w for w in new]), self._by_reference(new)
        if "" in new:  # the dummy prefix is not put before nothing; a marker alone is its piece
            wanted[new.index("")] = array("i", [self.model.pieces.index(MARK)]).tobytes()
        self.other.update(w for w, a, b in zip(new, found, wanted) if a != b)
        self.odd.update((w, t) for w, t in zip(new, self._decoded(wanted)) if t != " " + w.replace(MARK, " "))
        self.words.update(zip(new, wanted))
        ids = [b"".join(map(self.words.__getitem__, words)) for words in split]
        same = [not self.other or self.other.isdisjoint(words) for words in split]
        if not back:
            return ids, same, []
        whole = []
        for t, words in zip(texts, split):
            if self.odd and not self.odd.keys().isdisjoint(words):
                t = "".join([self.odd.get(w) or " " + w.replace(MARK, " ") for w in words])[1:]
            whole.append(t.replace(MARK, " "))
        return ids, same, whole

    def _new_words(self, split: list[list[str]]) -> list[str]:
        if len(self.words) > self.known_words:
            for known in (self.words, self.other, self.odd):
                known.clear()
        return list(set(itertools.chain.from_iterable(split)).difference(self.words))

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self._spread(lambda some: self.fast.encode_batch_fast(some, add_special_tokens=False), texts)
        return [array("i", e.ids).tobytes() for e in found]

    def _by_reference(self, texts: list[str]) -> list[bytes]:
        # Its lists are made under Python's lock, so threads would only wait for each other.
        return [array("i", x).tobytes() for x in self.reference.encode(texts, num_threads=1)]

    def decode(self, ids: list[bytes]) -> list[str]:
        return [self._whole(t) for t in self._decoded(ids)]

    def _decoded(self, ids: list[bytes]) -> list[str]:
        plain = [memoryview(x).cast("i").tolist() for x in ids]
        return self.fast.decode_batch(plain, skip_special_tokens=False)

    def _whole(self, text: str) -> str:
        return text[1:] if self.model.add_dummy_prefix and text.startswith(" ") else text


def _parts(batch, chars: int):
    """Slices of a record batch with about ``chars`` characters of text."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    cuts = np.unique(np.searchsorted(sizes, np.arange(chars, (sizes[-1] if len(sizes) else 0) + 1, chars)) + 1)
    for start, end in itertools.pairwise([0, *cuts[cuts < len(sizes)].tolist(), len(sizes)]):
        yield batch.slice(start, end - start)


def encode_documents(
    docs: DataFrame, model_bytes: bytes, verify_one_in: int = 1, threads: int | None = None, id_col: str = "doc_id", text_col: str = "text",
    known_words: int = KNOWN_WORDS, batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """One row per input row: doc_id, token_ids, n_tokens, n_byte_tokens, ids_sha256 (of the
    ids as little-endian 32-bit numbers), same_as_reference, decoded_sha256, round_trip.

    Whole texts are encoded in multithreaded batches and decoded again. same_as_reference
    tells whether sentencepiece gave the same ids for the text, word by word or as a whole (if
    not, its ids are the ones returned; NULL if ``verify_one_in`` left the text out, see Codec); round_trip whether decoding returned the text, which
    byte fallback makes true unless the model changes characters or the text holds the
    marker itself. A NULL text has the ids of the empty text, none; an empty table gives
    no rows and repeated rows come back repeated.

    Nothing is shuffled; a task holds one batch of texts and spreads it over ``threads``
    threads (default: spark.task.cpus, the cores that a task has). Smaller ``batch_chars`` and
    ``known_words`` save memory and cost time; the ids are the same.
    """
    threads = threads or int(docs.sparkSession.conf.get("spark.task.cpus", "1"))
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes)
    rows = rows_of(docs, doc_id=id_col, text=text_col)

    def run(batches):
        codec = Codec(shared.value, verify_one_in, threads, known_words)
        for batch in batches:
            for part in _parts(batch, batch_chars):
                some = [t or "" for t in part["text"].to_pylist()]
                ids, same, decoded = codec.encode_and_decode(some)
                lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                flat = np.frombuffer(b"".join(ids), "<i4")
                ends = np.cumsum(lengths)
                by_bytes = np.concatenate(([0], np.cumsum(codec.byte_ids[flat])))
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"],
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat)),
                    pa.array(lengths),
                    pa.array(by_bytes[ends] - by_bytes[ends - lengths]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array(same, pa.bool_()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded]),
                    pa.array([a == b for a, b in zip(decoded, some)]),
                ], ["doc_id", "token_ids", "n_tokens", "n_byte_tokens", "ids_sha256", "same_as_reference",
                    "decoded_sha256", "round_trip"])
        batch = part = some = ids = decoded = flat = by_bytes = codec = None
        release_memory()

    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, token_ids array<int>, n_tokens bigint, "
        "n_byte_tokens bigint, ids_sha256 string, same_as_reference boolean, decoded_sha256 string, round_trip boolean")


def decode_documents(rows: DataFrame, model_bytes: bytes, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(doc_id, text) from token ids; NULL ids give a NULL text."""
    shared = rows.sparkSession.sparkContext.broadcast(model_bytes)
    rows = rows_of(rows, doc_id=id_col, token_ids=ids_col)

    def run(batches):
        codec = Codec(shared.value, verify_one_in=0)
        for batch in batches:
            ids = batch["token_ids"].to_pylist()
            texts = codec.decode([array("i", x or []).tobytes() for x in ids])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([None if x is None else t for x, t in zip(ids, texts)], pa.string())],
                ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def read_model(path: str) -> bytes:
    """The model file, read by the driver (it is broadcast: some hundred kB to a few MB)."""
    with open(path, "rb") as file:
        return file.read()
