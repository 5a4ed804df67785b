"""Personal data: patterns, plus a character model that was trained on their spans.

The model is a bidirectional LSTM over characters with CRF transitions, trained in numpy.
Texts are covered by overlapping windows; the emissions of overlapping windows are merged
and one best path is decoded over the whole text. A tag other than "outside" is allowed
only within REACH characters of a digit or an @, which every kind has. Windows that cover
no such place cannot change the path, so they need not be computed.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortkit.llm.common import rows_of
from cohortkit.session import materialize

KINDS = ("email", "ip", "card", "phone")
N_TAGS = 1 + 2 * len(KINDS)  # 0 outside; 1 + 2k begins kind k, 2 + 2k is inside it
WINDOW, STRIDE = 64, 32
# How far from a digit or an @ the path may leave "outside".
REACH = 32
# Bounds of the training sample: documents drawn (about), of them used; windows with and
# without spans.
DRAWN_DOCS, SAMPLE_DOCS, SAMPLE_WINDOWS = 30_000, 2000, 1200
EMBED, HIDDEN = 12, 16
_AT_ONCE = 2048

_ANCHOR = re.compile(r"[0-9@]").finditer
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+").match
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind: str, found: str) -> bool:
    digits = _DIGITS.sub("", found)
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def _emails(text: str):
    """Matches of local@domain.domain, found from each @ (long runs stay linear)."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1) if start == at else free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    spans = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        spans += [(k, m.start(), m.end()) for m in pattern(text) if valid(KINDS[k], m.group())]
    return spans


def char_classes(text: str) -> np.ndarray:
    """ASCII as it is, other characters as one of two classes; 0 is padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points + 1, np.where(points < 0x250, 129, 130)).astype(np.int16)


N_CLASSES = 131


def allowed_places(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches within REACH characters of a digit or an @."""
    out: list[list[int]] = []
    for m in _ANCHOR(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def windows_over(places: list[tuple[int, int]]) -> list[int]:
    """Starts of the windows (one at every STRIDE) that cover one of the places."""
    out: list[int] = []
    for start, end in places:
        first = max(0, (start - WINDOW) // STRIDE + 1)
        after = out[-1] // STRIDE + 1 if out else 0
        out.extend(w * STRIDE for w in range(max(first, after), (end - 1) // STRIDE + 1))
    return out


def every_window(text: str) -> list[int]:
    """Starts of all windows of a text."""
    return list(range(0, len(text), STRIDE))


@dataclass
class Tagger:
    """Parameters by name: E, and W (input), U (recurrent), b of each direction, V, c, A."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 0) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"E": rng.normal(0, 0.3, (N_CLASSES, EMBED))}
        for d in "fb":
            p["W" + d] = rng.normal(0, 0.25, (EMBED, 4 * HIDDEN))
            p["U" + d] = rng.normal(0, 0.25, (HIDDEN, 4 * HIDDEN))
            p["b" + d] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
        p["V"], p["c"] = rng.normal(0, 0.2, (2 * HIDDEN, N_TAGS)), np.zeros(N_TAGS)
        p["A"] = np.zeros((N_TAGS, N_TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (B, T, H) of one direction over class ids (B, T)."""
        b, t = x.shape
        h = c = np.zeros((b, HIDDEN), np.float32)
        table = self.p["E"] @ self.p["W" + d] + self.p["b" + d]
        out = np.zeros((b, t, HIDDEN), np.float32)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            g = table[x[:, i]] + h @ self.p["U" + d]
            gates = 1 / (1 + np.exp(-g[:, : 3 * HIDDEN]))
            new = np.tanh(g[:, 3 * HIDDEN:])
            ig, fg, og = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            before, past = h, c
            c = fg * c + ig * new
            squashed = np.tanh(c)
            h = og * squashed
            out[:, i] = h
            if keep is not None:
                keep.append((i, before, past, ig, fg, og, new, squashed))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate((self._run(x, "f"), self._run(x, "b")), 2) @ self.p["V"] + self.p["c"]

    def transitions(self) -> np.ndarray:
        """Learned scores; going inside a kind is possible only from that kind."""
        allowed = np.ones((N_TAGS, N_TAGS), bool)
        for k in range(len(KINDS)):
            allowed[:, 2 + 2 * k] = False
            allowed[1 + 2 * k: 3 + 2 * k, 2 + 2 * k] = True
        return np.where(allowed, self.p["A"], -1e4).astype(np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag paths ``y`` and its gradient."""
        b, t = x.shape
        kept = {"f": [], "b": []}
        h = np.concatenate([self._run(x, d, kept[d]) for d in "fb"], 2)
        e, a = h @ self.p["V"] + self.p["c"], self.transitions()

        def lse(z, axis):
            top = z.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(z - top).sum(axis))

        start = np.where(np.arange(N_TAGS) % 2 == 0, -1e4, 0).astype(np.float32)
        start[0] = 0  # a path cannot begin inside a span
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = start + e[:, 0]
        for i in range(1, t):
            forward[:, i] = lse(forward[:, i - 1, :, None] + a, 1) + e[:, i]
        for i in range(t - 2, -1, -1):
            backward[:, i] = lse(a[None] + (e[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
        total = lse(forward[:, -1], 1)
        share = np.exp(forward + backward - total[:, None, None])
        rows, steps = np.arange(b)[:, None], np.arange(t)
        gold = e[rows, steps, y].sum(1) + a[y[:, :-1], y[:, 1:]].sum(1)
        de = share
        de[rows, steps, y] -= 1
        da = np.zeros_like(a)
        for i in range(1, t):
            da += np.exp(forward[:, i - 1, :, None] + a + (e[:, i] + backward[:, i])[:, None, :] - total[:, None, None]).sum(0)
        np.subtract.at(da, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        g = {"V": h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, N_TAGS), "c": de.sum((0, 1)),
             "A": np.where(a > -1e3, da, 0), "E": np.zeros_like(self.p["E"])}
        dh_all = de @ self.p["V"].T
        for n, d in enumerate("fb"):
            inputs = np.zeros((b, t, 4 * HIDDEN), np.float32)
            du = np.zeros_like(self.p["U" + d])
            dh = dc = np.zeros((b, HIDDEN), np.float32)
            for i, before, past, ig, fg, og, new, squashed in reversed(kept[d]):
                dh = dh + dh_all[:, i, n * HIDDEN:(n + 1) * HIDDEN]
                dc = dc + dh * og * (1 - squashed**2)
                dg = np.concatenate((dc * new * ig * (1 - ig), dc * past * fg * (1 - fg),
                                     dh * squashed * og * (1 - og), dc * ig * (1 - new**2)), 1)
                inputs[:, i] = dg
                du += before.T @ dg
                dh, dc = dg @ self.p["U" + d].T, dc * fg
            flat = inputs.reshape(-1, 4 * HIDDEN)
            by_class = np.zeros((N_CLASSES, 4 * HIDDEN), np.float32)
            np.add.at(by_class, x.ravel(), flat)
            g["W" + d], g["U" + d], g["b" + d] = self.p["E"].T @ by_class, du, flat.sum(0)
            g["E"] += by_class @ self.p["W" + d].T
        return float((total - gold).mean()), {k: (v / b).astype(np.float32) for k, v in g.items()}


def train(windows: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 64, seed: int = 0) -> Tagger:
    """Adam over shuffled batches; without windows an untrained model that finds nothing."""
    tagger = Tagger.fresh(seed)
    if not len(windows):
        tagger.p["c"][0] = 50.0
        return tagger
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(x) for k, x in tagger.p.items()}
    step, planned = 0, epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            _, g = tagger.gradients(windows[some], tags[some])
            norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
            step += 1
            rate = 0.02 * (1 - step / (planned + 1))
            for k in tagger.p:
                d = g[k] * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d**2
                tagger.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return tagger


def _window(classes: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int16)
    part = classes[start:start + WINDOW]
    out[: len(part)] = part
    return out


def tagged_windows(text: str):
    """(window, tags) of every window of a whole text, by its pattern spans."""
    spans, classes = base_spans(text), char_classes(text)
    tags = np.zeros(len(classes) + WINDOW, np.int64)
    for k, s, e in sorted(spans, key=lambda x: (x[2] - x[1], x)):  # of overlapping ones the longest
        tags[s:e] = 2 + 2 * k
        tags[s] = 1 + 2 * k
    for start in every_window(text):
        y = tags[start:start + WINDOW].copy()
        for i in np.flatnonzero((y % 2 == 0) & (y > 0)):  # a window may begin inside a span; its rest is a span too
            if i == 0 or y[i - 1] not in (y[i], y[i] - 1):
                y[i] -= 1
        yield _window(classes, start), y


def training_windows(texts: list[str], most: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags: the first ``most`` with spans and as many without."""
    kept = {True: [], False: []}
    for x, y in itertools.chain.from_iterable(map(tagged_windows, texts)):
        some = kept[bool(y.any())]
        if len(some) < most:
            some.append((x, y))
    return _stacked(kept[True], kept[False])


def _stacked(with_spans: list, without: list) -> tuple[np.ndarray, np.ndarray]:
    if not with_spans:
        return np.zeros((0, WINDOW), np.int16), np.zeros((0, WINDOW), np.int64)
    both = with_spans + without
    return np.stack([x for x, _ in both]), np.stack([y for _, y in both])


def _window_rows(batches):
    """Of the sampled texts every window as bytes: those with spans, those without but near a
    digit or an @ (from which the model learns most), and the others."""
    for batch in batches:
        for text in batch["text"]:
            text = text.as_py()
            near = set(windows_over(allowed_places(text)))
            rows = [(xxhash.xxh64_intdigest(x.tobytes(), 7) >> 1, 0 if y.any() else 1 if start in near else 2, x.tobytes(), y.astype(np.int8).tobytes())
                    for start, (x, y) in zip(every_window(text), tagged_windows(text))]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                ["draw", "kind", "x", "y"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """Trains on a bounded sample: of the DRAWN_DOCS documents (about) with the smallest id
    hashes those with a digit or an @, SAMPLE_DOCS at most. Their whole texts are cut into
    windows inside tasks, with the spans of the patterns as labels; of all windows the driver
    gets the SAMPLE_WINDOWS with the smallest hashes that have spans, as many without
    (three of four near a digit or an @), and no text."""
    rows = rows_of(docs, doc_id=id_col, text=text_col)
    share = min(1.0, DRAWN_DOCS / max(1, rows.count()))
    draw = F.xxhash64(F.lit("pii"), F.col("doc_id").cast("string")).cast("double") / 2.0**64 + 0.5
    near = rows.select(draw.alias("draw"), "doc_id", "text").where(F.col("draw") <= share).where(F.col("text").rlike("[0-9@]"))
    # The sample is chosen by id and hash of the text; texts stay where they are.
    marked = near.withColumn("mark", F.xxhash64("text"))
    last = marked.select("draw", "mark").orderBy("draw", "mark").limit(SAMPLE_DOCS).agg(F.max(F.struct("draw", "mark")).alias("m")).first()["m"]
    if last is None:
        return train(*_stacked([], []))
    within = F.struct("draw", "mark") <= F.struct(F.lit(last[0]).alias("draw"), F.lit(last[1]).alias("mark"))
    # Rows with equal ids and texts teach once.
    sample = marked.where(within).groupBy("draw", "mark").agg(F.max("text").alias("text"))
    windows = materialize(sample.select("text").mapInArrow(_window_rows, "draw bigint, kind int, x binary, y binary"))
    found = []
    for kind, most in ((0, SAMPLE_WINDOWS), (1, SAMPLE_WINDOWS * 3 // 4), (2, SAMPLE_WINDOWS // 4)):
        some = windows.where(F.col("kind") == kind).distinct().orderBy("draw", "x", "y").limit(most).collect()
        found.append([(np.frombuffer(r["x"], np.int16), np.frombuffer(r["y"], np.int8).astype(np.int64)) for r in some])
    return train(*_stacked(found[0], found[1] + found[2]))


class _Path:
    """The best path over a stretch whose merged emissions come window by window.

    Only the rows that a later window may still add to are held; of the others there is a byte
    a tag, so the memory and the time of a stretch grow with its length.
    """

    def __init__(self, tagger: Tagger, start: int, length: int, allowed: list[tuple[int, int]]):
        self.a, self.start, self.length, self.at = tagger.transitions(), start, length, start
        self.allowed, self.next = allowed, 0
        self.total, self.weights = np.zeros((WINDOW, N_TAGS), np.float32), np.zeros((WINDOW, 1), np.float32)
        self.score, self.back = None, []

    def add(self, start: int, emitted: np.ndarray, weight: np.ndarray):
        self._settle(start)
        self.total += emitted * weight
        self.weights += weight

    def _settle(self, upto: int):
        """Rows before ``upto`` are complete: step over them."""
        n = min(upto, self.start + self.length) - self.at
        if n <= 0:
            return
        rows = self.total[:n] / self.weights[:n]
        open_ = np.zeros(n, bool)
        while self.next < len(self.allowed) and self.allowed[self.next][0] < self.at + n:
            s, e = self.allowed[self.next]
            open_[max(0, s - self.at):max(0, e - self.at)] = True
            if e > self.at + n:
                break
            self.next += 1
        rows[~open_, 1:] = -1e4
        back = np.zeros((n, N_TAGS), np.int8)
        for i in range(n):
            if self.score is None:
                closed = (np.arange(N_TAGS) % 2 == 0) & (np.arange(N_TAGS) > 0)
                self.score = np.where(closed, -1e4, 0) + rows[i]
                continue
            every = self.score[:, None] + self.a
            back[i] = every.argmax(0)
            self.score = every.max(0) + rows[i]
            self.score -= self.score.max()  # however long the stretch, sums stay small
        self.back.append(back)
        self.total = np.concatenate((self.total[n:], np.zeros((n, N_TAGS), np.float32)))
        self.weights = np.concatenate((self.weights[n:], np.zeros((n, 1), np.float32)))
        self.at += n

    def spans(self) -> list[tuple[int, int, int]]:
        self._settle(self.start + self.length)
        back = np.concatenate(self.back) if self.back else np.zeros((0, N_TAGS), np.int8)
        if not len(back):
            return []
        tags = np.zeros(len(back), np.int8)
        tag = int(self.score.argmax())
        for i in range(len(back) - 1, -1, -1):
            tags[i] = tag
            tag = back[i, tag]
        out = []
        for s in np.flatnonzero(tags % 2 == 1).tolist():
            e = s + 1
            while e < len(tags) and tags[e] == tags[s] + 1:
                e += 1
            out.append(((int(tags[s]) - 1) // 2, self.start + s, self.start + e))
        return out


def model_spans(texts: list[str], tagger: Tagger, every: bool = False) -> list[list[tuple[int, int, int]]]:
    """Spans of the model alone, of whole texts; overlapping windows are merged with more
    weight on a window's middle before the path is decoded.

    With ``every`` all windows are computed and each text is one stretch. The spans are the
    same: a place that may leave "outside" has all its windows either way, and between two
    stretches every place is outside.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    allowed = [allowed_places(t) for t in texts]
    places = ((i, s) for i, t in enumerate(texts) for s in (every_window(t) if every else windows_over(allowed[i])))
    weight = (1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)[:, None]
    classes: dict[int, np.ndarray] = {}
    path, of, upto = None, -1, -1
    while part := list(itertools.islice(places, _AT_ONCE)):
        for i in {i for i, _ in part}:
            if i not in classes:
                classes[i] = char_classes(texts[i])
        emitted = tagger.emissions(np.stack([_window(classes[i], s) for i, s in part]))
        for (i, s), e in zip(part, emitted):
            if path is None or i != of or s > upto:
                if path is not None:
                    found[of] += path.spans()
                path = _Path(tagger, s, 0, allowed[i])
                # Stretches before this one are done with their places.
                path.next = bisect.bisect_left(allowed[i], (s, 0))
                path.next -= path.next > 0 and allowed[i][path.next - 1][1] > s
                of = i
            upto = s + WINDOW
            path.length = min(upto, len(texts[i])) - path.start
            path.add(s, e, weight)
        classes = {i: classes[i] for i in list(classes)[-1:]}
    if path is not None:
        found[of] += path.spans()
    return found


def all_spans(base: list[tuple[int, int, int]], found: list[tuple[int, int, int]], text: str) -> list[tuple[int, int, int]]:
    """The pattern spans, and those of the model that overlap none of them and pass the
    kind's own check (an email also needs an @ between two signs)."""
    spans, held = list(base), sorted((s, e) for _, s, e in base)
    starts, ends = [s for s, _ in held], list(itertools.accumulate((e for _, e in held), max))
    for k, s, e in found:
        part = text[s:e]
        fits = valid(KINDS[k], part) if k else bool(re.search(r"\S@\S", part))
        before = bisect.bisect_left(starts, e)  # pattern spans that start before the end
        if fits and not (before and ends[before - 1] > s):
            spans.append((k, s, e))
    return sorted(spans)


def find_pii(docs: DataFrame, tagger: Tagger, every: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (pattern spans),
    base_sha256 (of those spans), spans (all spans, kind:start:end joined by commas), n_added.

    Whole texts are searched; NULL counts as empty and has no spans. Positions are code
    points, ends exclusive. Spans of different kinds may overlap; spans of the model never
    overlap one of a pattern. Repeated rows come back repeated; an empty table gives none.

    One pass without a shuffle; the broadcast model has some thousand numbers. ``every``
    computes all windows, with the same result (see ``model_spans``).
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    rows = rows_of(docs, doc_id=id_col, text=text_col)

    def written(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            base = [base_spans(t) for t in texts]
            spans = [all_spans(b, f, t) for b, f, t in zip(base, model_spans(texts, shared.value, every), texts)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"]]
                + [pa.array([sum(x[0] == k for x in b) for b in base], pa.int64()) for k in range(len(KINDS))]
                + [pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string()),
                   pa.array([written(s) for s in spans], pa.string()),
                   pa.array([len(s) - len(b) for s, b in zip(spans, base)], pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"n_{k} bigint" for k in KINDS)
        + ", base_sha256 string, spans string, n_added bigint")
