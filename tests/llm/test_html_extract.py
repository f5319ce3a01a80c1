"""Main text of pages: kept and dropped parts, decoding, and the trees' arithmetic."""

from __future__ import annotations

import html
import re

import numpy as np
import pytest

from shelfmark.llm import html_extract
from shelfmark.llm.dom import blocks, parse

FULL = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><!-- no --><div id=ad1 class='ad banner'>Buy now, it is cheap.</div>
<article><h1>Head&amp;line</h1><p>First   para&shy;graph
with <b>bold<i> and</b> <a href=x>a link</a>.<p>Second &lt;one&gt; &#233;&nbsp;x<ul><li>item one<li>item two</ul>
<aside>Related: <a href=/x>other things</a></aside><form><input value=x>Your mail</form></article>
<section class=comments><h2>Comments</h2><p>Great article, thanks a lot for it, really nice.</p></section>
<footer>&copy; 2024 site</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture(scope="module")
def trees(spark):
    return html_extract.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_article_only(spark, trees):
    row = html_extract.extract(pages(spark, [(1, "u", FULL)]), trees).first()
    assert row.text == "Head&line\nFirst para­graph with bold and a link.\nSecond <one> é x\nitem one\nitem two"


def test_supplied_pages_equal_their_articles(spark, trees):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_extract.extract(table, trees).collect():
        inside = re.search(r"<article><h1>(.*?)</h1>(.*?)(</article>|$)", r.html, re.S)
        parts = [inside[1], *re.split(r"<p>|<br>|</p>", inside[2])]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in parts]
        assert r.text == "\n".join(line for line in lines if line)
        assert r.n_chars == len(r.text)


def test_pages_that_mark_nothing_are_read_by_density(spark, trees):
    prose = "This is a long sentence of the main text, and it goes on for a while. " * 6
    body = f"<div><a href=1>One</a> <a href=2>Two</a></div><div><p>{prose}</p><p>{prose}</p></div><div><a href=3>Imprint</a></div>"
    text = html_extract.extract(pages(spark, [(1, "u", f"<html><body>{body}</body></html>")]), trees).first().text
    assert text.count("main text") == 12 and "Imprint" not in text


def test_decoding_is_consistent():
    rng = np.random.default_rng(2)
    for seed in range(50):
        depth = "".join(rng.choice(["<div>", "</div>", "text ", "<p>", "<ul><li>"], 40))
        page = parse(depth)
        kept = html_extract.decode(page, rng.normal(0, 2, len(page.nodes)))
        for node, keep in zip(page.nodes, kept):
            if keep and node.parent > 0:
                assert kept[node.parent], seed


@pytest.mark.parametrize(
    ("markup", "lines"),
    [
        ("a<br>b<div>c</div>d", ["a b", "c", "d"]),
        ("<p>x<p>y", ["x", "y"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>z", ["1", "2", "3", "z"]),
        ("a<!-- <p>b</p> -->c", ["ac"]),
        ("1 < 2 & 3 > 2 &amp;amp; &notit;", ["1 < 2 & 3 > 2 &amp; ¬it;"]),
        ("<p title='a>b'>x</p>", ["x"]),
        ("<textarea><p>no</textarea>y", ["y"]),
        ("<b>bo</b>ld", ["bold"]),
        ("tail <p", ["tail"]),
    ],
)
def test_blocks_of_markup(markup, lines):
    page = parse(markup)
    assert blocks(page, [True] * len(page.nodes)).split("\n") == lines


def test_exported_trees_equal_the_library(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rng = np.random.default_rng(4)
    rows = [([float(v) for v in x], float(x[0] * x[1] > 0)) for x in rng.normal(0, 1, (400, 3))]
    frame = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label", "x")
    model = GBTClassifier(maxIter=4, maxDepth=html_extract.DEPTH, seed=1).fit(frame)
    expected = [r.m for r in model.transform(frame).select(vector_to_array("rawPrediction")[1].alias("m")).collect()]
    got = html_extract._exported(model).margins(np.array([r[0] for r in rows]))
    assert got / 2 == pytest.approx(expected)


def test_headings_and_slugs_of_an_article_stay(spark, trees):
    prose = "This is a long sentence of the main text, and it goes on for a while. " * 4
    menu = "".join(f"<li><a href={i}>A long entry of the menu, number {i}</a>" for i in range(60))
    inside = f'<h2 id="side-effects">Effects</h2><section id="legal-background"><p>{prose}</p></section><h3 id="hidden-costs">Costs</h3><p>{prose}</p>'
    for classes in ("post", "post tag-social", "post no-sidebar", "post social"):
        page = f'<html><body><nav><ul>{menu}</ul></nav><article class="{classes}">{inside}</article></body></html>'
        text = html_extract.extract(pages(spark, [(1, "u", page)]), trees).first().text
        assert text.count("main text") == 8 and "Effects" in text and "Costs" in text and "menu" not in text, classes


class Sure:
    """Trees that are sure of every node."""

    def margins(self, x):
        return np.full(len(x), html_extract.CLIP)


def test_sure_trees_outweigh_a_word_within_a_name(spark):
    prose = "This is a long sentence of the main text, and it goes on for a while. "
    within = ('<section class="related-work"><p>{}</p></section>', '<p class="legal-text">{}</p>')
    alone = ('<div class="side-effects"><p>{}</p></div>', '<h2 id="copyright-law">{}</h2>', '<div id="search-algorithms"><p>{}</p></div>')
    other = ('<section class="comments"><p>{}</p></section>', '<div class="comment-list"><p>{}</p></div>', "<nav>{}</nav>", '<div id="cookie-notice">{}</div>')
    rows = [f"<article><p>{prose * 5}</p>{part.format('Here it is.')}</article>" for part in within]
    rows += [f"<div><p>{prose * 5}</p>{part.format('Here it is.')}</div>" for part in (*alone, *other)]
    found = html_extract.extract(pages(spark, [(i, "u", x) for i, x in enumerate(rows)]), Sure()).collect()
    assert [("Here it is." in r.text) for r in sorted(found)] == [True] * 5 + [False] * 4


def test_decoding_is_the_best_consistent_choice():
    """Against all choices on small trees."""
    import itertools
    import math

    rng = np.random.default_rng(3)
    for _ in range(40):
        page = parse("".join(rng.choice(["<div>", "</div>", "some text ", "<p>"], 9)))
        n = len(page.nodes)
        margins = rng.normal(0, 2, n)
        score = margins * np.array([0.05 + math.log1p(x.own) for x in page.nodes])

        def value(kept):
            return sum(s if k else -s for s, k in zip(score[1:], kept, strict=True))

        def consistent(kept):
            full = [True, *kept]
            return all(full[x.parent] or not full[i] for i, x in enumerate(page.nodes) if i)

        best = max(value(k) for k in itertools.product([False, True], repeat=n - 1) if consistent(k))
        assert value(html_extract.decode(page, margins)[1:]) == pytest.approx(best)


@pytest.mark.parametrize("markup", ["<p>x</p>" * 100_000, "<div>" * 100_000 + "x", "<p><table><td>" + "<div>" * 50_000, "<b><a>" * 50_000 + "x"])
def test_time_grows_with_the_page(markup):
    import time

    start = time.perf_counter()
    page = parse(markup)
    marks = html_extract._marks(page)
    html_extract.node_features(page, marks)
    html_extract.decode(page, html_extract._plain_margins(page, marks) + html_extract._prior(page, marks))
    assert time.perf_counter() - start < 10
