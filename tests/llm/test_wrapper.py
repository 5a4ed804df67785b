"""Main text of pages: made pages whose article is known, tree matching, odd markup."""

import functools
import html
import random

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import wrapper
from cohortkit.llm.wrapper import Page, parse_shape, tree_match

WORDS = "thand ing erst mei él größe a&b x<y of".split()


def made(rng, host, n):
    """(html, text) of page n of a host: a template of the host around a text."""
    line = lambda k=12: " ".join(rng.choices(WORDS, k=rng.randrange(3, k)))
    title, paragraphs = line(), [line(30) for _ in range(rng.randrange(1, 7))]
    e = html.escape
    body = "".join(f"<p>{e(p).replace(' of ', ' <b>of</b> ')}{rng.choice(['</p>', '', ' <br></p>'])}" for p in paragraphs)
    menu = "".join(f"<li><a href='/{i}'>{e(line(5))}</a>" for i in range(rng.randrange(2, 6)))
    style = host % 3
    if style == 0:  # named by elements
        page = (f"<!DOCTYPE html><html><head><title>{e(title)}</title><script>var a = '<p>no</p>';</script></head><body><nav><ul>{menu}</ul></nav>"
                f"<div class=ad>{e(line())}</div><article><h1>{e(title)}</h1>{body}</article><footer>&copy; {e(line())}</footer>")
    elif style == 1:  # named by classes; the notice in the main element is the same on all pages
        page = (f"<body><div id='top-menu'>{menu}</div><main><h2>{e(title)}</h2><p class='legal-line'>All pages of host {host} say so.</p>{body}"
                f"<div class='user-comments'><p>{e(line())}</p></div></main><aside>{e(line())}</aside><form>{e(line())}<input></form></body>")
    else:  # no names at all: what stays the same is template
        page = (f"<html><body><div>Welcome to host {host}</div><div><ul>{menu}</ul></div><div><h3>{e(title)}</h3>{body}</div>"
                f"<div>Call us <i>today</i></div></body></html>")
    return page, "\n".join(" ".join(t.split()) for t in [title, *paragraphs])


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {"host": F.lit("x"), "shape_id": F.lit(1), "template": F.lit("y"), "slots": F.lit(0)})
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in wrapper.extract_text(df).collect()}


def test_known_articles(spark):
    rng = random.Random(11)
    pages = [made(rng, i % 6, i) for i in range(180)]
    got = extracted(spark, [(i, f"https://h{i % 6}.example.org/{i}", p) for i, (p, _) in enumerate(pages)])
    for i, (_, want) in enumerate(pages):
        assert got[i] == (want, len(want)), i


def test_copies_teach_nothing(spark):
    """A host that has one page many times keeps its text; so do few different pages."""
    page = "<body><div>Same words</div><div><p>One text</p></div></body>"
    got = extracted(spark, [(i, "http://a.example/x", page) for i in range(40)] + [(99, "http://b.example/", page)])
    assert set(got.values()) == {("Same words\nOne text", 19)}


def test_hot_host_and_two_templates(spark):
    rng = random.Random(2)
    pages = [made(rng, 2 if i % 4 else 0, i) for i in range(200)]
    got = extracted(spark, [(i, "//no host", p) for i, (p, _) in enumerate(pages)])
    assert sum(got[i][0] == want for i, (_, want) in enumerate(pages)) == 200


ODD = [
    (None, ""), ("", ""), ("plain  text\n&amp; more", "plain text & more"), ("<p>a<p>b", "a\nb"), ("<!-- x", ""), ("a<!-->b", "ab"),
    ("<script>x</scripty></script >y", "y"), ("<style>", ""), ("a < b & c", "a < b & c"), ("<p title='>'>t</p>", "t"), ("<p don't>t</p>", "t"),
    ("</p></div>t", "t"), ("<ul><li>a<li>b</ul>c", "a\nb\nc"), ("<td>1<td>2<tr><td>3", "1\n2\n3"), ("x<div hidden>y</div>z", "x\nz"),
    ("<p>a<br>b</p>", "a b"), ("<b>un<i>closed", "unclosed"), ("<textarea><p>no</textarea>yes", "yes"), ("<div class='no-sidebar'>in</div>", "in"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\nx"), ("<p>&#x41;&lt;b&gt;&nbsp;</p>", "A<b>"), ("<p unclosed", ""),
]


@pytest.mark.parametrize("source, want", ODD)
def test_odd_markup(source, want):
    assert "\n".join(t for _, t in Page(source).blocks) == want


def test_odd_rows(spark):
    rows = [(i, None, s) for i, (s, _) in enumerate(ODD)] + [(None, "http://x/", "<p>n</p>"), (3, "u", "<p>r</p>"), (3, "u", "<p>r</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = wrapper.extract_text(df).collect()
    assert len(got) == len(rows) and sum(r["text"] == "r" for r in got) == 2
    assert wrapper.extract_text(df.limit(0)).collect() == []


def test_long_pages():
    text = "word " * 400_000
    assert Page(f"<p>{text}</p>").blocks == [(1, text.strip())]
    assert len(Page("<p>x" * 100_000).blocks) == 100_000
    assert Page("<div>" * 100_000 + "deep").blocks[0][1] == "deep"
    assert wrapper.slot_keys(Page("<div>" * 3000 + "deep").shape(), Page("<div>" * 2000).shape())


def test_tree_match_is_best():
    """The matched nodes' weight against a search over all ordered matchings."""
    rng = random.Random(4)

    def shape():
        lines = ["-1 "]
        for i in range(1, rng.randrange(2, 9)):
            lines.append(f"{rng.randrange(i)} {rng.choice(['p', 'div.a', 'div.b', 'ul'])}")
        return "\n".join(lines)

    for _ in range(200):
        one, other = shape(), shape()
        (ka, ca), (kb, cb) = parse_shape(one), parse_shape(other)
        tag = lambda k: k.split(".")[0]

        @functools.cache
        def most(a, b):
            def lists(x, y):
                if not x or not y:
                    return 0
                best = max(lists(x[1:], y), lists(x, y[1:]))
                if tag(ka[x[0]]) == tag(kb[y[0]]):
                    best = max(best, most(x[0], y[0]) + lists(x[1:], y[1:]))
                return best
            return 2 + (ka[a] == kb[b]) + lists(tuple(ca[a]), tuple(cb[b]))

        matched = tree_match(one, other)
        assert sum(2 + (ka[a] == kb[b]) for a, b in matched.items()) == most(0, 0)
        assert len(set(matched.values())) == len(matched)
