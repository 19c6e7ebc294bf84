import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.boosting import boost
from strata.llm.common import staged
from strata.llm.html_dom import attributes, read
from strata.llm.html_extract import decode, extract, main_texts, train


@pytest.fixture(scope="module")
def model():
    return train()


def test_reader_tree():
    dom = read('<p><b>x<br><p>y<ul><li>1<li>2<ul><li>3</ul></ul><script>"</p>"</script><table><tr><td>a<td>b</table>t < u')
    got = [(t, dom.tag[p] if p >= 0 else None) for t, p in zip(dom.tag, dom.parent)]
    assert got == [("#page", None), ("p", "#page"), ("b", "p"), ("br", "b"), ("p", "#page"), ("ul", "#page"), ("li", "ul"),
                   ("li", "ul"), ("ul", "li"), ("li", "ul"), ("script", "#page"), ("table", "#page"), ("tr", "table"),
                   ("td", "tr"), ("td", "tr")]
    assert "".join(t or "|" for _, t in dom.pieces).endswith("t < u")
    assert attributes(' class="a b" ID=x hidden data-q=\'1>2\' class=z') == {"class": "a b", "id": "x", "hidden": "", "data-q": "1>2"}


@pytest.mark.parametrize("bad", ['<a href="', "<", "<div ", "<p>", "<b>", "<!--", "<a b='c\" ", "<ul><li>", "</i>", "<i><p></i>", "&#x110000;&bogus;&#0;"])
def test_reader_takes_anything(bad, model):
    assert isinstance(main_texts(model, [bad * 3000])[0], str)


def test_decode_matches_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(1, 8)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        logit = np.array([rng.gauss(0, 2) for _ in range(n)])
        p = 1 / (1 + np.exp(-logit))
        best = max((sum(np.log(p[i] if k else 1 - p[i]) for i, k in enumerate(keep)), keep)
                   for rest in itertools.product([False, True], repeat=n - 1) for keep in [(True, *rest)]
                   if all(not k or i == 0 or keep[parent[i]] for i, k in enumerate(keep)))
        assert decode(parent, logit) == list(best[1])


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 1] > 0) ^ (x[:, 4] > 0.5)).astype(float)
    trees = boost(x[:2000], y[:2000], trees=20)
    assert (((trees.logits(x[2000:]) > 0) == y[2000:]).mean()) > 0.95


BODY = "<h1>A &amp; B</h1><p>First  paragraph,\n with <b>bold</b>ness and a <a href='/x'>link</a>.<p>Caf&eacute; &#x4e2d;&nbsp;text, long enough to be prose.<br>Next line.</p>"
TEXT = "A & B First paragraph, with boldness and a link. Café 中 text, long enough to be prose. Next line."
PAGES = [
    f'<html><head><title>T</title></head><body><nav><a href="/">Home</a> <a href="/a">About</a></nav><article>{BODY}</article><footer>&copy; 2024 Us</footer></body></html>',
    f'<body><div class="header"><a href="/">Site</a></div><div id="main"><div class="post-content">{BODY}</div><div class="sidebar"><h3>Recent</h3><ul><li><a href="/1">one</a><li><a href="/2">two</a></ul></div></div><div class="footer">All rights</div>',
    f'<body><div class="cookie-banner"><p>We use cookies to improve things.</p><button>OK</button></div><main><article>{BODY}<div class="ad">Buy one now</div></article></main><section id="comments"><div class="comment"><p>What a fine article, I have read it twice and liked it.</p></div></section>',
    f'<body><header><h2>Site name</h2><form action="/s"><input name=q><button>Go</button></form></header><script>var x = "<article>no</article>";</script><style>p{{}}</style><article class="entry">{BODY}</article><aside><p>About the author of this.</p></aside></body>',
]


def test_main_text(model):
    assert main_texts(model, PAGES) == [TEXT] * len(PAGES)


def test_defined_cases(spark, model):
    long = "<article>" + "".join(f"<p>Paragraph {i} has some words in it, as prose has.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, "a"), (2, "", "b"), (3, "   ", None), (4, PAGES[0], "d"), (4, PAGES[0], "d"), (5, "just some text &lt;b&gt;", "e"),
            (6, "<script>x</script><!-- c -->", "f"), (7, long, "g")]
    df = staged(spark, spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, html string, url string, text string, __llm_x string"), "pages")
    got = extract(spark, df, model, F.col("page_id"), F.col("url")).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[3] == by[6] == "" and by[4] == TEXT and by[5] == "just some text <b>"
    assert by[7].startswith("Paragraph 0 has") and by[7].endswith("as prose has.") and by[7].count("Paragraph") == 20_000
    assert extract(spark, df.limit(0), model, F.col("page_id")).count() == 0


def test_reading_is_linear_in_nesting():
    import time

    n = 100_000
    soups = ["<p><button>" + "<div>" * n, "<b>" + "<div>" * n + "</b>" * n, "<li><ul>" + "<div>" * n + "<li>" * n,
             "<td><table>" + "<span>" * n + "<td>x" * n, "<p>" * n, "<option><select>" + "<i>" * n + "<option>" * n]
    for soup in soups:
        at = time.perf_counter()
        dom = read(soup)
        assert len(dom.tag) > n and time.perf_counter() - at < 4


def test_references_end_with_their_piece(model):
    page = "<html><body><article><h1>Rates</h1><p>AT&<b>amp;</b>T and Q&amp;A &lt;here&gt; " + "plain words of the story " * 40 + "</p></article></body></html>"
    text = main_texts(model, [page])[0]
    assert "AT&amp;T and Q&A <here>" in text
