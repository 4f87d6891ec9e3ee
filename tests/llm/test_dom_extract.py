"""Main-text extraction: exact texts on generated pages, whatever wraps the article."""
import html
import re

import numpy as np
import pytest
from edges import LONG_TEXT, rows_of

from tidemark.llm.dom_extract import FEATURES, KINDS, Model, Tree, extract, main_text, train

SF = "/root/testdata/sf0.01"
SHAPES = [("<article>", "</article>"), ("<div>", "</div>"), ("", ""), ('<div class="post-content">', "</div>"),
          ("<section><div>", "</div></section>"), ('<div id="page"><main><div>', "</div></main></div>")]


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF}/pages.parquet").select("html"))


def reference(page):
    """What the generated article holds, by cutting at its tags."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", article)
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in parts)
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("shape", SHAPES)
def test_generated_pages(spark, model, shape):
    pages = [h for h, in rows_of(spark.read.parquet(f"{SF}/pages.parquet"), "html")]
    wrong = [p for p in pages if extract(p.replace("<article>", shape[0]).replace("</article>", shape[1]), model) != reference(p)]
    assert not wrong


PAGE = """<html><head><title>x</title></head><body><header><a href=/>Home</a> My Site</header>
<div class=cookie-notice>We use cookies, and you agree to them by staying on this page. Yes.</div><nav><ul><li><a>One</a></ul></nav>
<main><article><header><h1>Title here &amp; there</h1></header><p>First para, with <a href=x>some link</a> text&nbsp;and words.<p>Second
one.<ul><li>item one<li>item two</ul><table><tr><td>cell a<td>cell b</table><aside>Related: this</aside>
<form><label>Email</label><input><button>Go</button></form><script>var x = "<p>no</p>";</script></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Great article, I think that this is a good one.</p></div></section></main>
<aside class=sidebar><p>Popular stuff, that you may like to read now.</p></aside><footer>(c) 2020 Site. All rights reserved.</footer></body></html>"""
TEXT = "Title here & there\nFirst para, with some link text and words.\nSecond one.\nitem one\nitem two\ncell a\ncell b"


def test_furniture_is_left_out(model):
    assert extract(PAGE, model) == TEXT
    assert extract(PAGE.replace("article>", "div>").replace("main>", "div>"), model) == TEXT


def test_marginals_are_exact_on_a_small_tree(model):
    """Sum-product against the sum over all labellings."""
    tree = Tree("<div class=menu>a b<p>Some words, here.</p></div><section><p>x</p></section>")
    kinds, features, n = tree.kinds(), tree.features(), len(tree.tag)
    weight = np.zeros((n, 2))
    total = 0.0
    for bits in range(1 << n):
        y = [bits >> i & 1 for i in range(n)]
        w = np.exp(sum(model.odds[f] for i in range(n) if y[i] for f in features[i]))
        for i in range(1, n):
            w *= model.edge[kinds[i]][y[tree.parent[i]]][y[i]]
        total += w
        for i in range(n):
            weight[i, y[i]] += w
    assert np.allclose(model.marginals(tree), weight[:, 1] / total)


def test_edge_pages(spark, model):
    deep = "<div>" * 3000 + "<p>Down here, a text.</p>"
    pages = [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", "just text &lt;here&gt;.", "t"), (4, "w", PAGE, "t"), (4, "w", PAGE, "t"),
             (5, "x", f"<article><p>{LONG_TEXT}</p></article>", "t"), (6, "y", "<p>a<p>b</p></p></b><", "t"), (7, "z", deep, "t"),
             (10, "s", "<p>Before <a href='x>after</a> the open quote, and more text.</p>", "t"), (8, "q", "<script>no", "t"), (9, "r", "<!-- <p>no</p> -->", "t")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = rows_of(main_text(df, model=model), "page_id", "url", "text")
    want = dict(zip(range(len(pages)), ["", "", "just text <here>.", TEXT, TEXT, LONG_TEXT, "a\nb\n<", "Down here, a text.",
                                            "Before after the open quote, and more text.", "", ""]))
    assert sorted(got, key=str) == sorted(((p[0], p[1], want[i]) for i, p in enumerate(pages)), key=str)
    assert main_text(df.limit(0)).count() == 0


def test_without_labelled_pages():
    assert extract("<nav>Menu</nav><div><p>A text, with some words.</p></div>", Model(np.zeros(KINDS * 4 + FEATURES * 2))) != "Menu"


ARTICLE = "<body><nav><a>Home</a></nav><article><h1>A title</h1><p>First words, of the article. More of them here.</p>{}<p>Last words, of the article.</p></article><footer>(c) 2020</footer></body>"
KEPT = {
    '<h2 id="related-work">Related work</h2>': "Related work",
    '<p id="notice">Notice that this is text, of the article.</p>': "Notice that this is text, of the article.",
    '<section id="legal-history"><h2>History</h2><p>It began, as such things do, in court.</p></section>': "History\nIt began, as such things do, in court.",
    '<div class="text-share"><p>The share of text, in percent, is high.</p></div>': "The share of text, in percent, is high.",
    '<p>With <span class="tags">tagged words</span> and a <b class="search-term">term</b>.</p>': "With tagged words and a term.",
    "<p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> as known.</p>": "Energy is E=mc2 as known.",
    "<p>See <object data=x>the fallback</object> and <svg><text>the label</text></svg> here.</p>": "See the fallback and the label here.",
}


@pytest.mark.parametrize("inner", KEPT)
def test_words_in_an_article_are_judged_with_what_surrounds_them(model, inner):
    assert extract(ARTICLE.format(inner), model) == f"A title\nFirst words, of the article. More of them here.\n{KEPT[inner]}\nLast words, of the article."


def test_hostile_markup_takes_linear_time():
    import time

    pages = {"open quotes": lambda n: "<a '" * n, "one end": lambda n: "<a '" * n + ">", "declarations": lambda n: "<!" * n, "names": lambda n: "<a<" * n,
             "unmatched ends": lambda n: "<b class=ads>" * n + "</i>" * n, "rules in phrases": lambda n: "<p><button>" + "<b class=ads>" * n + "<hr>" * n,
             "deep": lambda n: "<div>" * n + "<li>" * n, "skipped": lambda n: "<script>" * n, "comments": lambda n: "<!-- " * n}
    for name, page in pages.items():
        took = []
        for n in (20_000, 40_000):
            began = time.process_time()
            Tree(page(n))
            took.append(time.process_time() - began)
        assert took[1] < 3 * max(took[0], 0.3), (name, took)


def test_scanner_on_plain_cases():
    from tidemark.llm.dom_extract import tokens

    cut = lambda p: [(p[a:b], close, tag) for a, b, close, tag, _ in tokens(p)]
    assert cut("a<b x='>' y=\">\">c</b ><br/>") == [("<b x='>' y=\">\">", False, "b"), ("</b >", True, "b"), ("<br/>", False, "br")]
    assert cut("1 < 2 <3> <i>") == [("<i>", False, "i")] and cut("x<!-- <p> -->y<!--z") == [("<!-- <p> -->", False, ""), ("<!--z", False, "")]
    assert cut("<![CDATA[a<b]]>c<![CDATA[d") == [("<![CDATA[a<b]]>", False, ""), ("<![CDATA[d", False, "")]
    assert cut("<SCRIPT>if (a<b) </p></Script >x<style>y") == [("<SCRIPT>if (a<b) </p></Script >", False, ""), ("<style>y", False, "")]
    assert cut("<!DOCTYPE html><?xml?><a") == [("<!DOCTYPE html>", False, ""), ("<?xml?>", False, "")]
