"""Main text of web pages, by wrapper induction over the pages of a host.

Pages are read as trees of block elements in which repeated siblings are one node. The
trees of a host are aligned with its commonest tree by simple tree matching, so that a node
of the template is the same slot on every page. Over all pages of the host, slots whose
text stays the same are template and slots whose text varies are content; what kind of
element a slot is in (menu, advert, footer, ...) decides among the varying ones.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortkit.llm.common import release_memory, rows_of
from cohortkit.operators.sizing import small_side
from cohortkit.session import materialize

# A slot is template if this share of at least so many different pages gives it one text.
CONSTANT_SHARE = 0.9
CONSTANT_PAGES = 5
# Outside of the main element, slots with more than this share of link text are menus.
LINK_SHARE = 0.6
# Deeper elements belong to the slot of their ancestor at this depth.
DEPTH = 200
# Child lists with a larger table are matched by equal keys in order.
CELLS = 250_000

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
CLOSE_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SCOPE = frozenset("html table td th caption object template button marquee applet".split())
# An element that opens ends these open ones, if they lie inside of those.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "body": ({"head"}, set()),
}
# Units of which a page has as many as its text needs.
REPEATED = frozenset("p li tr td th dt dd h2 h3 h4 h5 h6 blockquote pre figure option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that are not part of an article, by name, role, and words of class and id.
NOT_TEXT = frozenset("nav footer aside form head template dialog svg object audio video canvas map select button menu search "
                     "datalist fieldset".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs header masthead topbar footer sidebar widget widgets related recommended recommendations "
    "share sharing social comment comments commentlist disqus respond responses reply replies cookie cookies consent gdpr notice "
    "notices alert alerts popup modal overlay newsletter subscribe subscription signup login search pagination pager copyright disclaimer toolbar".split())
NEGATED = frozenset("has no with without".split())
PAGE = frozenset("html body main".split())

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(>|\Z)"
    r"|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """A page's blocks of text and its tree of slots.

    ``keys``, ``parents``: of each slot, in order of first sight (slot 0 is the page).
    ``blocks``: (slot, text) in page order, of the innermost kind of main element the page
    has: article, else main, else the whole page. ``linked``: characters of links by slot.
    """

    def __init__(self, source: str | None):
        self.keys, self.parents, self._child, self._depth = [""], [-1], {}, [0]
        self.heading = {0: False}
        found = self._read(source or "")
        self.level = max((level for _, _, _, level in found), default=0)
        self.blocks, self.linked = [], {}
        for slot, text, links, level in found:
            if level == self.level:
                self.blocks.append((slot, text))
                self.linked[slot] = self.linked.get(slot, 0) + links

    def shape(self) -> str:
        """The tree as lines of (parent, key)."""
        return "\n".join(f"{p} {k}" for p, k in zip(self.parents, self.keys))

    def _slot(self, parent: int, key: str, tag: str) -> int:
        if self._depth[parent] >= DEPTH:
            return parent
        slot = self._child.get((parent, key))
        if slot is None:
            slot = self._child[parent, key] = len(self.keys)
            self.keys.append(key)
            self.parents.append(parent)
            self._depth.append(self._depth[parent] + 1)
            self.heading[slot] = tag in HEADINGS
        return slot

    def _read(self, source: str):
        out, pieces, links = [], [], 0
        # Open elements: tag, slot, whether left out, level of the main element, inside a link,
        # whether a p is open that the next block ends, ordinals of unnamed children.
        stack = [("", 0, False, 0, False, False, {})]
        opened: dict[str, int] = {}

        def flush():
            nonlocal links
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    out.append((stack[-1][1], text, links, stack[-1][3]))
                pieces.clear()
                links = 0

        def pop():
            tag = stack[-1][0]
            if tag not in INLINE:
                flush()
            stack.pop()
            opened[tag] -= 1

        def pop_through(tags, inside):
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in tags:
                    while len(stack) > at:
                        pop()
                    return
                if stack[at][0] in inside:
                    return

        def add(text):
            nonlocal links
            _, _, out_of, _, link, _, _ = stack[-1]
            if not out_of:
                text = html.unescape(text) if "&" in text else text
                pieces.append(text)
                if link:
                    links += len(text)

        at = 0
        while True:
            token = _TAG.search(source, at)
            if token is None:
                add(source[at:])
                break
            if token.start() > at:
                add(source[at:token.start()])
            at = token.end()
            end, tag, attributes, closed = token.groups()
            if tag is None or not closed:
                continue
            tag = tag.lower()
            if end:
                if opened.get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            if tag in RAW:
                last = _RAW_END[tag].search(source, at)
                at = last.end() if last else len(source)
                continue
            if tag == "br":
                add(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in CLOSE_P and stack[-1][5]:
                pop_through({"p"}, SCOPE)
            if tag in ENDS:
                ended, inside = ENDS[tag]
                if any(opened.get(t) for t in ended):
                    pop_through(ended, inside)
            _, slot, out_of, level, link, p_open, ordinals = stack[-1]
            values = {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
            inline = tag in INLINE
            if not inline:
                flush()
            names = values.get("class", "")
            if not out_of:
                out_of = self._left_out(tag, values, level)
                if not inline:
                    named = _DIGITS.sub("#", " ".join(sorted(names.split())))
                    key = f"{tag}.{named}" if named else tag
                    if not named and tag not in REPEATED:
                        # Unnamed containers are told apart by their place.
                        n = ordinals[tag] = ordinals.get(tag, 0) + 1
                        key = f"{tag}~{n}" if n > 1 else tag
                    slot = self._slot(slot, key.replace("\n", " "), tag)
                if tag == "article" or values.get("itemprop") == "articleBody":
                    level = 2
                elif (tag == "main" or values.get("role") == "main") and level < 2:
                    level = 1
            p_open = tag == "p" or (p_open and tag not in SCOPE)
            stack.append((tag, slot, out_of, level, link or tag == "a", p_open, ordinals if inline else {}))
            opened[tag] = opened.get(tag, 0) + 1
        while len(stack) > 1:
            pop()
        flush()
        return out

    @staticmethod
    def _left_out(tag: str, values: dict, level: int) -> bool:
        if tag in NOT_TEXT or tag == "header" and not level:
            return True
        if not values or tag in PAGE:
            return False
        if "hidden" in values or values.get("aria-hidden") == "true" or _HIDDEN.search(values.get("style", "")):
            return True
        if values.get("role", "").lower() in NOT_ROLES or values.get("itemprop") == "comment":
            return True
        before = ""
        for word in _WORD.findall(f"{values.get('class', '')} {values.get('id', '')}"):
            word = word.lower()
            # The header of an article holds its title. Two words may be one: side-bar, pop-up.
            named = word in NOT_WORDS or before + word in NOT_WORDS
            if named and before not in NEGATED and not (word == "header" and level):
                return True
            before = word
        return False


def parse_shape(shape: str) -> tuple[list[str], list[list[int]]]:
    """(keys, children) of the tree that Page.shape wrote."""
    keys, children = [], []
    for place, line in enumerate(shape.split("\n")):
        parent, _, key = line.partition(" ")
        keys.append(key)
        children.append([])
        if place:
            children[int(parent)].append(place)
    return keys, children


def tree_match(one: str, other: str) -> dict[int, int]:
    """Slots of ``one`` to slots of ``other`` by simple tree matching.

    Roots match; below a matched pair, children of the same tag are matched in order so that
    most nodes match, those with equal names before those of the tag alone.
    """
    (keys_a, below_a), (keys_b, below_b) = parse_shape(one), parse_shape(other)
    if one == other:
        return {i: i for i in range(len(keys_a))}
    tag = lambda key: re.split(r"[.~]", key, maxsplit=1)[0]
    tags_a, tags_b = [tag(k) for k in keys_a], [tag(k) for k in keys_b]
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def children(a: int, b: int) -> tuple[list[int], list[int], list]:
        """Children to be matched, and the pairs that are fixed since the table would be too large."""
        left, right = below_a[a], below_b[b]
        if len(left) * len(right) <= CELLS:
            return left, right, []
        places = {keys_b[y]: n for n, y in enumerate(right)}
        fixed, upto = [], -1
        for x in left:
            n = places.get(keys_a[x], -1)
            if n > upto:
                fixed.append((x, right[n]))
                upto = n
        return [], [], fixed

    def score(a: int, b: int) -> int:
        """Twice the matched nodes, and one for each equal name."""
        if (a, b) in memo:
            return memo[a, b][0]
        left, right, fixed = children(a, b)
        own = 2 + (keys_a[a] == keys_b[b])
        if fixed:
            memo[a, b] = own + sum(score(x, y) for x, y in fixed), fixed
            return memo[a, b][0]
        table = [[0] * (len(right) + 1)]
        for x in left:
            above, row = table[-1], [0]
            for j, y in enumerate(right):
                best = max(above[j + 1], row[j])
                if tags_a[x] == tags_b[y]:
                    best = max(best, above[j] + score(x, y))
                row.append(best)
            table.append(row)
        pairs, i, j = [], len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
        memo[a, b] = own + table[-1][-1], pairs
        return memo[a, b][0]

    score(0, 0)
    matched, todo = {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        matched[a] = b
        todo.extend(memo[a, b][1])
    return matched


def slot_keys(shape: str, reference: str) -> list[int]:
    """The template's key of each slot of ``shape``: a place in ``reference``, or for a slot
    that matches none (as a negative number) a hash of its path."""
    matched = tree_match(shape, reference)
    paths, keys = [], []
    for place, line in enumerate(shape.split("\n")):
        parent, _, key = line.partition(" ")
        paths.append(xxhash.xxh64_intdigest(f"{paths[int(parent)] if place else 0}/{key}"))
        keys.append(matched.get(place, -1 - (paths[-1] >> 1)))
    return keys


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_SLOT = pa.struct([("slot", pa.int32()), ("text", pa.int64()), ("chars", pa.int64()), ("links", pa.int64()), ("kind", pa.int32())])
_BLOCK = pa.struct([("slot", pa.int32()), ("text", pa.string())])


def _shape_id(page: Page) -> int:
    return _signed(xxhash.xxh64_intdigest(page.shape()))


def _summaries(batches):
    """Of each page its tree and of each slot a hash of its text, its size and kind."""
    for batch in batches:
        shapes, ids, slots = [], [], []
        for source in batch["html"].to_pylist():
            page = Page(source)
            texts: dict[int, list[str]] = {}
            for slot, text in page.blocks:
                texts.setdefault(slot, []).append(text)
            shapes.append(page.shape())
            ids.append(_shape_id(page))
            slots.append([
                {"slot": slot, "text": _signed(xxhash.xxh64_intdigest("\n".join(some))), "chars": sum(map(len, some)),
                 "links": page.linked[slot], "kind": 0 if not page.level else 2 if page.heading[slot] else 1}
                for slot, some in sorted(texts.items())])
        yield pa.RecordBatch.from_arrays(
            [batch["host"], pa.array(ids, pa.int64()), pa.array(shapes, pa.string()), pa.array(slots, pa.list_(_SLOT))],
            ["host", "shape_id", "shape", "slots"])
    release_memory()


def _blocks(batches):
    for batch in batches:
        ids, blocks = [], []
        for source in batch["html"].to_pylist():
            page = Page(source)
            ids.append(_shape_id(page))
            blocks.append([{"slot": slot, "text": text} for slot, text in page.blocks])
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], batch["host"], pa.array(ids, pa.int64()), pa.array(blocks, pa.list_(_BLOCK))],
            ["page_id", "url", "host", "shape_id", "blocks"])
    release_memory()


def _aligned(batches):
    for batch in batches:
        keys = [slot_keys(a, b) for a, b in zip(batch["shape"].to_pylist(), batch["reference"].to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch["host"], batch["shape_id"], pa.array(keys, pa.list_(pa.int64()))], ["host", "shape_id", "keys"])
    release_memory()


def learn_wrappers(pages: DataFrame) -> DataFrame:
    """(host, shape_id, template): for each tree of a host that has any, the slots of it
    that are template. ``pages``: host, html; every page counts.

    Pages of equal text and tree count once, so copies of one page teach nothing. The
    commonest tree of a host (the smaller hash of equally common ones) is its reference;
    each different tree of the host is aligned with it in a row of its own, and slots are
    counted by (host, slot, text), so a host with a third of all pages is spread over tasks.
    """
    seen = materialize(pages.mapInArrow(
        _summaries, "host string, shape_id bigint, shape string, "
        "slots array<struct<slot: int, text: bigint, chars: bigint, links: bigint, kind: int>>"))
    different = seen.select("host", "shape_id", "slots").distinct()
    shapes = materialize(seen.groupBy("host", "shape_id", "shape").agg(F.count(F.lit(1)).alias("n")))
    references = shapes.groupBy("host").agg(F.min_by("shape", F.struct(-F.col("n"), "shape_id")).alias("reference"))
    aligned = materialize(shapes.join(small_side(references), "host").select("host", "shape_id", "shape", "reference").mapInArrow(
        _aligned, "host string, shape_id bigint, keys array<bigint>"))
    texts = different.select("host", "shape_id", F.explode("slots").alias("s")).select("host", "shape_id", "s.*")
    texts = texts.groupBy("host", "shape_id", "slot", "text", "chars", "links", "kind").agg(F.count(F.lit(1)).alias("n"))
    texts = texts.join(small_side(aligned), ["host", "shape_id"]).withColumn("key", F.element_at("keys", F.col("slot") + 1))
    texts = texts.groupBy("host", "key", "text").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("chars")).alias("chars"), F.sum(F.col("n") * F.col("links")).alias("links"),
        F.max("kind").alias("kind"))
    slots = texts.groupBy("host", "key").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.max("kind").alias("kind"))
    constant = (F.col("n") >= CONSTANT_PAGES) & (F.col("most") >= CONSTANT_SHARE * F.col("n")) & (F.col("kind") < 2)
    menu = (F.col("kind") == 0) & (F.col("links") > LINK_SHARE * F.col("chars"))
    template = materialize(slots.where(constant | menu).select("host", "key"))
    each = aligned.select("host", "shape_id", F.posexplode("keys").alias("slot", "key"))
    # A list has at most the slots of one tree.
    return each.join(small_side(template), ["host", "key"]).groupBy("host", "shape_id").agg(F.collect_set("slot").alias("template"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of ``pages``: the blocks of the
    page's main text, in page order, one to a line.

    A block is the text of a block element between other block elements, character
    references decoded and white space made one space. Blocks come from the page's
    articles, else from its main element, else from the whole body; without elements
    that are no article text (menus, headers outside of articles, footers, sidebars, notices, adverts,
    forms, comments, scripts, hidden elements) and without slots that the host's wrapper
    knows as template. Headings of an article always stay.

    NULL and empty html give an empty text; text without markup is one block. Pages with
    a NULL or odd url share the host ''. Repeated rows come back repeated; a host with few
    different pages (below CONSTANT_PAGES) has no constant slots; an empty table gives no rows. Each page is
    read twice instead of writing its text in between; only wrappers, whose size is
    counted, are broadcast (or joined by a shuffle, when large).
    """
    rows = rows_of(pages, page_id=id_col, url=url_col, html=html_col)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = rows.withColumn("host", host)
    wrappers = materialize(learn_wrappers(rows.select("host", "html")))
    id_type = rows.schema["page_id"].dataType.simpleString()
    blocks = rows.select("page_id", F.col("url").cast("string").alias("url"), "host", "html").mapInArrow(
        _blocks, f"page_id {id_type}, url string, host string, shape_id bigint, blocks array<struct<slot: int, text: string>>")
    kept = F.expr("filter(blocks, b -> template IS NULL OR NOT array_contains(template, b.slot))")
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    found = blocks.join(small_side(wrappers), ["host", "shape_id"], "left").select("page_id", "url", text.alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
