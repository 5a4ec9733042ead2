"""Operator 13: best region against brute force, and pages of other layouts than the learned ones."""

import random

import pytest
from helpers import SF

from nestloom.llm import page_text
from nestloom.llm.page_text import PageModel, Token

PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def model(spark):
    return page_text.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_region_has_the_highest_sum():
    rng = random.Random(2)
    for _ in range(300):
        found = [Token(rng.choice(["word a", "word b", "tag x", "tag y"]), rng.randint(1, 4)) for _ in range(rng.randint(0, 12))]
        m = PageModel({"word a": 1.0, "word b": 2.5, "tag x": -1.5, "tag y": -4.0})
        begin, end = m.region(found)
        sums = [sum(m.weight(t) for t in found[i:j]) for i in range(len(found)) for j in range(i + 1, len(found) + 1)]
        assert sum(m.weight(t) for t in found[begin:end]) == pytest.approx(max([0.0, *sums]))


def test_words_score_positive_and_tags_negative(model):
    assert all((v > 0) == k.startswith("word") for k, v in model.weights.items())
    assert model.weights["tag li"] < model.weights["tag p"]


ARTICLE = "<h1>A title of some words</h1>" + "".join(f"<p>Paragraph {i} has quite a lot of words in it, so that it reads like the text of an article.</p>" for i in range(6))
BODY = "\n".join(["A title of some words"] + [f"Paragraph {i} has quite a lot of words in it, so that it reads like the text of an article." for i in range(6)])
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>About us</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>&copy; Example</footer></body></html>",
        f"<body><div>{MENU}</div><div>{ARTICLE}</div><div>{MENU}</div></body>",
        f"<div class='site-header'>Our site <b>welcome</b></div><main>{ARTICLE}</main><div id=sidebar><p>Other news of the day that is not part of it.</p></div>",
        f"<article><header><h1>A title of some words</h1></header>{ARTICLE.split('</h1>')[1]}</article><section class='comments'><p>I liked reading this very much, thank you!</p></section>",
        f"<p class=cookie-notice>We use cookies to make this site better for all of you.</p><article>{ARTICLE.replace('</h1>', '</h1><div class=ad>Buy now, <i>cheap</i>!</div>')}<form><label>Name</label></form></article>",
        f"<ARTICLE>{ARTICLE}<script>if (a < b) {{ document.write('<p>no</p>') }}</script><!-- <p>hidden</p> --><style>p > b {{}}</style></ARTICLE>",
        f"<article>{ARTICLE}<aside>See also this and that and more of it.</aside></article><div role=contentinfo>All rights reserved by the owner of this site.</div>",
        f"<article>{ARTICLE}",
        f"<nav><a href=x>Broken menu<article>{ARTICLE}</article>",
    ],
)
def test_layouts(model, page):
    text = model.text(page)
    assert text == BODY or (page.startswith("<nav><a href=x>") and text.endswith(BODY))


def test_references_white_space_and_blocks(model):
    html = "<article><h1>One  &amp;&#32;two</h1><p>a&lt;b&gt;\n\t c&eacute;<br>d <b>e</b>f</p><p> \n</p><table><tr><td>x</td><td>&#x79;</td></tr></table></article>"
    assert model.text(html) == "One & two\na<b> cé d ef\nx\ny"


def test_rows(spark, model):
    long = "<article>" + "<p>many words in a very long page</p>" * 60_000 + "</article>"
    given = spark.createDataFrame(
        [(1, "u", None), (2, "u", ""), (None, None, "<p>x y z</p>"), (3, "v", "<div></div>"), (3, "v", "<div></div>"), (4, "w", long)], PAGES
    ).selectExpr("*", "7 AS n_chars", "'q' AS text", "1 AS `a.b`", "2 AS _html2")
    got = sorted(page_text.extract(given, model).collect(), key=str)
    assert [c for c in page_text.extract(given, model).columns] == ["page_id", "url", "a.b", "_html2", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, len(r["text"]), r["n_chars"]) for r in got) == [(0, 5, 5), (1, 0, 0), (2, 0, 0), (3, 0, 0), (3, 0, 0), (4, 60_000 * 31 - 1, 60_000 * 31 - 1)]


def test_without_labelled_pages(spark):
    none = spark.createDataFrame([], PAGES)
    m = page_text.fit(none)
    assert page_text.extract(none, m).collect() == []
    assert m.text("<div><a>x</a></div><p>one two three four</p>") == "one two three four"
    plain = spark.createDataFrame([(1, "u", "<p>one two three</p>")], PAGES)
    assert page_text.extract(plain, page_text.fit(plain)).first()["text"] == "one two three"


def test_unclosed_quotes_do_not_take_long(model):
    assert isinstance(model.text("<a href=\"" * 5000 + "<p>" + "word " * 100), str)
