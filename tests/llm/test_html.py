from __future__ import annotations

import time

import numpy as np
import pytest

from ledgerline.llm import html
from ledgerline.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return html.fit(labelled_pages())


def small_tree() -> html.Forest:
    tree = html.Tree([-1, 0, 0, 1, 1], [False, False, True, True, True], [[0], [1, 2], [3], [4, 1], [2]], [0] * 5)
    return html.forest([tree])


def test_messages_give_exact_chances():
    rng = np.random.default_rng(3)
    trees = small_tree()
    model = html.Model(rng.normal(size=len(html.FEATURES)), rng.normal(size=(3, 2, 2)))
    weights = np.zeros((32, 5))
    total = np.zeros(32)
    for state in range(32):
        labels = [state >> i & 1 for i in range(5)]
        weights[state] = labels
        own = sum(model.weight[c] for r, c in zip(trees.rows, trees.columns, strict=True) if labels[r])
        total[state] = own + sum(model.pair[trees.kind[i], labels[trees.parent[i]], labels[i]] for i in range(1, 5))
    chance = np.exp(total - total.max())
    want = (weights * chance[:, None]).sum(axis=0) / chance.sum()
    assert np.allclose(model.content(trees), want)


def test_held_out_pages(model):
    trees = [html.parse(p) for p in labelled_pages(3, seed=77)]
    together = html.forest(trees)
    label = np.array([y for t in trees for y in t.label])
    texts = together.kind == 1
    assert ((model.content(together) >= 0.5) == label)[texts].mean() > 0.95


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- <p>hidden</p> --><div class="ad">Buy this now.</div>
<article><h1>A  title &amp; more</h1><p>First &lt;b&gt; para, with a <a href="x">link</a> and
text that goes on.<br>Next line.</p><p>Second&nbsp;para, caf&eacute; &#233; longer than a menu would be.<P>Third one, never closed, with more words in it.</article>
<footer>&copy; me, all rights reserved.</footer></body></html>"""


def test_page(model):
    assert html.extract([PAGE], model) == [
        "A title & more\n\nFirst <b> para, with a link and text that goes on. Next line.\n\n"
        "Second para, café é longer than a menu would be.\n\nThird one, never closed, with more words in it."
    ]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></p>", "<!-- open", "<script>x", "<p a='>", "<" * 5000, "<a \"" * 3000, "<p>" * 20_000, "<div>" * 3000 + "x"])
def test_broken_pages(model, page):
    assert isinstance(html.extract([page], model)[0], str)


PROSE = "A first sentence that is long enough to be prose, and goes on for a while. Then a second one follows it."
ARTICLE = f"<article><h1>A title of the page</h1><p>{PROSE}</p><p>More: {PROSE}</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><body>{ARTICLE}</body></html>",
        f"<html><head><title>T</title><meta charset=x>{ARTICLE}",
        f"<html><head><title>T</title><template><b>x</b><body>{ARTICLE}",
        f"<html><head><title>T</title></head><head><body><head>{ARTICLE}",
        f"<html><head><title>T<body>{ARTICLE}",
        f"<html><head><style>p {{}}<body>{ARTICLE}",
        f"<body><template>{ARTICLE}",
        f"<body><div><object data=x></div>{ARTICLE}",
        f"<body><object data=x>{ARTICLE}",
        f"<body><object><object></object>{ARTICLE}",
        f"<body><svg><path d=x><text>label</text>{ARTICLE}",
        f"<body><math><mi>x</mi>{ARTICLE}",
        f"<body><svg><foreignObject><p>drawn</p></foreignObject></svg><template><p>{PROSE}</p></template>{ARTICLE}",
    ],
)
def test_silent_elements_without_end_tag(model, page):
    assert html.extract([page], model) == [f"A title of the page\n\n{PROSE}\n\nMore: {PROSE}"]


def test_text_ends_a_head():
    for page in ("<head><title>T</title>bare text", "<head><title>T</title><span>bare text</span>", "<head>\n<link href=x> bare text</head>"):
        assert list(html.parse(page).text.values()) == ["bare text"]


@pytest.mark.parametrize(
    "inner, text",
    [
        ("First part <script>var a = '<p>';</script> and the second", "First part and the second"),
        ("First part <svg><path d=x/><text>label</text></svg> and the second", "First part and the second"),
        ("First <svg><title>t</title><g><desc>d</desc></g></svg>part", "First part"),
        ("Read <ruby>kanji<rp>(</rp><rt>reading</rt><rp>)</rp></ruby> here", "Read kanjireading here"),
        ("See <my-term class=x>this term</my-term> and <x-y><b>that</b></x-y>.", "See this term and that."),
        ("Press <button>the <b>key</b></button> now", "Press now"),
        ("Watch <video><source src=x>No video</video> it", "Watch it"),
        ("A <select><option>one<option>two</select> choice <textarea><p>x</textarea> here", "A choice here"),
        ("One <template><p>two</p><div>three</div></template> four <math><mi>x</mi></math> five", "One four five"),
        ("An <unknown>element <other/> that</unknown> goes on", "An element that goes on"),
        ("Bare <noscript><p>text</p></noscript> word<iframe src=x>y</iframe>s", "Bare words"),
    ],
)
def test_lines_go_on_after_what_stands_within_them(inner, text):
    for outer in ("<p>{}</p>", "<body><div>{}</div><p>", "<ul><li>{}</ul>"):
        assert list(html.parse(outer.format(inner)).text.values()) == [text]


@pytest.mark.parametrize("inner, texts", [
    ("one<div>two</div>three", ["one", "two", "three"]), ("one<hr>two", ["one", "two"]), ("one<p>two<p>three", ["one", "two", "three"]),
    ("one<svg><g><div>two</div>three", ["one", "two", "three"]), ("<p>one <svg><path></p><p>two</p>", ["one", "two"]),
    ("one<legend>two</legend>", ["one", "two"]), ("<b>one</b><h2>two</h2>", ["one", "two"]),
])
def test_blocks_end_a_line(inner, texts):
    assert list(html.parse(f"<body>{inner}").text.values()) == texts


@pytest.mark.parametrize("tag", ["div", "p", "svg", "span", "li", "x-y", "template", "table", "figure"])
def test_time_goes_with_the_length(model, tag):
    """Fifty thousand nested elements, closed and not."""
    for page in (f"<{tag}>" * 50_000 + "text" + f"</{tag}>" * 50_000, f"<{tag}>a" * 50_000):
        start = time.perf_counter()
        assert isinstance(html.extract([page], model)[0], str)
        assert time.perf_counter() - start < 6


def test_tables_and_edges(spark, model):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html.extracted(pages, model).collect()
    assert [r["n_chars"] for r in out] == [len(html.extract([PAGE], model)[0])] * 2 + [0, 0]
    assert out[2]["text"] == "" and out[2]["page_id"] is None
    assert html.extracted(pages.limit(0), model).count() == 0
