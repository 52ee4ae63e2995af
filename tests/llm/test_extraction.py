"""Extraction: the reader of blocks, the random field against sums over all labellings, held-out pages."""

import html as references
import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from gridmeter.llm import extraction, queries
from gridmeter.llm.page_blocks import read
from gridmeter.llm.page_samples import labelled_pages
from tests.llm.conftest import SF, table


@pytest.fixture(scope="module")
def model():
    return extraction.train()


def texts(page):
    return [b.text for b in read(page)[0]]


def test_blocks():
    assert texts("<p>a <b>b</b>\n c<p>d<ul><li>e<li>f</ul>g") == ["a b c", "d", "e", "f", "g"]
    assert texts("<div>x<script>var a='</div><p>';</script>y<style>p{}</style></div><!-- <p>no</p> -->z") == ["x y", "z"]
    assert texts("<P CLASS=q>A&amp;B &lt;p&gt; &nbsp;&eacute;&#233; &am</P>1 < 2 <3") == ["A&B <p> éé &am", "1 < 2 <3"]
    assert texts('<p title="a > b">c</p><p title=it\'s>d</p><p x="never closed>e</p>') == ["c", "d", "e"]
    assert texts("a<br>b<br/>c<wbr>d") == ["a b cd"]
    assert texts("</p></div>end without start</section>") == ["end without start"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert texts("text <a href='x") == ["text"] and texts("<!-- open") == [] and texts("<script>open") == [] and texts("") == []
    blocks, title = read("<title>T &amp; U</title><div class='postBody main-text' hidden><p><a href=x>ab</a>cd")
    assert title == "T & U" and blocks[0].linked == 2 and blocks[0].tag == "p"
    assert blocks[0].around == {"in div", "in p", "hidden"} | {f"{k} {w}" for k in ("named", "near") for w in ("post", "body", "main", "text")}


def test_long_and_deep_pages_take_time_by_length():
    assert len(texts("<div class='a'>" * 50_000 + "x" + "</div>" * 50_000)) == 1
    assert len(texts("<p a='" * 20_000 + "x")) <= 20_000
    assert len(texts("<p>word</p>" * 100_000)) == 100_000
    assert texts("<" * 100_000) == ["<" * 100_000]


def test_field_against_all_labellings():
    """Marginals by their effect (the gradient is zero at the optimum) and Viterbi against enumeration."""
    emission, moves, start = [0.3, -1.2, 0.8, 0.1, -0.4], [[0.5, -0.7], [-0.2, 0.9]], -0.3

    def worth(y):
        return start * y[0] + sum(e * k for e, k in zip(emission, y, strict=True)) + sum(moves[a][b] for a, b in zip(y, y[1:], strict=False))

    best = max(itertools.product((0, 1), repeat=5), key=worth)
    assert extraction.viterbi(emission, moves, start) == list(best)
    assert extraction.viterbi([], moves, start) == []


def test_fit_reaches_the_likelihood_optimum():
    """No small step from the fitted weights raises the likelihood, summed over all labellings."""
    pages = [([{"a"}, {"a", "b"}, {"b"}], [1, 1, 0]), ([{"b"}, {"a"}], [0, 1]), ([{"a"}, {"b"}, {"b"}], [0, 0, 1]), ([{"b"}], [0])]
    m = extraction.fit(pages, steps=3_000, ridge=0.05)

    def objective(w, moves, start):
        total = 0.0
        for fs, labels in pages:
            e = [sum(w[f] for f in sorted(b)) for b in fs]

            def worth(y, e=e):
                return start * y[0] + sum(a * k for a, k in zip(e, y, strict=True)) + sum(moves[a][b] for a, b in zip(y, y[1:], strict=False))

            total += worth(labels) - math.log(sum(math.exp(worth(y)) for y in itertools.product((0, 1), repeat=len(fs))))
        square = sum(v * v for v in w.values()) + sum(v * v for row in moves for v in row) + start * start
        return total / 9 - 0.05 / 2 * square

    here = objective(m["weights"], m["moves"], m["start"])
    for d in (-0.05, 0.05):
        for f in ("a", "b"):
            assert objective(m["weights"] | {f: m["weights"][f] + d}, m["moves"], m["start"]) < here
        assert objective(m["weights"], m["moves"], m["start"] + d) < here
        for i, j in itertools.product((0, 1), repeat=2):
            moved = [[v + d * ((a, b) == (i, j)) for b, v in enumerate(row)] for a, row in enumerate(m["moves"])]
            assert objective(m["weights"], moved, m["start"]) < here


def test_held_out_pages(model):
    """Blocks of composed pages that training has not seen."""
    reader, right, found, due = extraction.Reader(model), 0, 0, 0
    for page in labelled_pages(300, seed=4_321, mark=extraction.MARK):
        want = [t.replace(extraction.MARK, "") for t in texts(page) if extraction.MARK in t]
        got = reader.main_blocks(page.replace(extraction.MARK, ""))
        found, due = found + len(got), due + len(want)
        right += len(set(got) & set(want))
    assert right / found > 0.97 and right / due > 0.97


PAGE = """<html><head><title>Big news</title></head><body>
<header><div class=logo>Site</div><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to improve this site. Read our policy.</p><button>OK</button></div>
{a}<h1>Big news</h1><p>First paragraph of the article, long enough to read.</p>
<div class="ad"><p>Buy this now, it is cheap and good.</p></div>
<ul><li>One point of the article</li><li>Another point</li></ul><p>Short.</p>{z}
<div class="sidebar"><h3>Popular</h3><p>Some other story that many have read.</p></div>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>I do not agree with this at all.</p></div></section>
<form class="newsletter"><p>Leave your address here.</p><input></form>
<footer><p>&copy; 2020 The site. All rights reserved.</p></footer></body></html>"""


@pytest.mark.parametrize("a, z", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"),
                                  ('<main><article class="entry">', "</article></main>")])
def test_what_is_no_article_is_left_out(model, a, z):
    assert extraction.Reader(model).main_blocks(PAGE.format(a=a, z=z)) == [
        "Big news", "First paragraph of the article, long enough to read.", "One point of the article", "Another point", "Short."]


def article_of(page):
    """The blocks of the article of the given pages, whose articles hold h1 and p alone."""
    part = page[page.index("<article>") + 9:page.index("</article>")]
    found = [" ".join(references.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", part)]
    return "\n\n".join(x for x in found if x)


def test_query_on_all_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op11_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]
        assert (r["text"], r["n_chars"], r["url"]) == (article_of(page["html"]), len(article_of(page["html"])), page["url"])


def test_odd_pages(spark, tmp_path):
    """Null and empty pages, no markup, repeated rows, null ids, columns with clashing names."""
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (None, None, "<article><p>One text here.</p></article>"),
            (5, "u", "<article><p>One text here.</p></article>"), (5, "u", "<article><p>One text here.</p></article>"),
            (6, "u", "<article><p>" + "long text " * 200_000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("x") for c in ("text", "n_chars", "score")})
    got = sorted((tuple(r)[:1] + (r["text"], r["n_chars"]) for r in queries.op11_extraction(spark, table(str(tmp_path), "pages", df)).collect()), key=repr)
    one = "One text here."
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "", 0), (None, one, 14), (5, one, 14), (5, one, 14),
                          (6, ("long text " * 200_000).strip(), 1_999_999)], key=repr)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert queries.op11_extraction(spark, table(str(tmp_path), "pages", df)).collect() == []


def test_train_on_given_pages():
    pages = [("<h1>T</h1><div class=x><p>Body text.</p></div><footer>F</footer>", ["T", "Body text."])] * 5
    assert extraction.Reader(extraction.train(pages)).main_blocks(pages[0][0]) == ["T", "Body text."]
