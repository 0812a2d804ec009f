"""Article text that markup of unusual form must not hide."""

import time

import pytest

from tidemark.llm.htmltext import extract, main_text

CASES = [
    ("<p title=it's>Hello</p><p>It's x</p><p>More</p>", "Hello\nIt's x\nMore"),
    ("<p title='a>b' lang = \"x>y\">Hello</p>", "Hello"),
    ('<p title="open>Hello</p><p>More</p>', "Hello\nMore"),
    ("<main><h2 class='search-engines'>Engines</h2><p class='side-effects'>Side effects are real.</p>"
     "<p>More than half of the text of this page is in here, by far.</p></main>",
     "Engines\nSide effects are real.\nMore than half of the text of this page is in here, by far."),
    ("<article><p>Kept text of the page.</p><p class='related-posts'>Also read</p><p class='notice'>Sale</p></article>", "Kept text of the page."),
    ("<p>text <math><mi>x</mi></math> y</p>", "text x y"),
    ("<article><p>a <label>b</label> c</p></article><label>Search</label>", "a b c"),
]


@pytest.mark.parametrize("source,text", CASES)
def test_text_is_kept(source, text):
    assert extract(source, None, set()) == text


def test_of_a_host(spark):
    rows = [(i, "http://h/x", source) for i, (source, _) in enumerate(CASES)]
    found = main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()
    assert {r["page_id"]: r["n_chars"] for r in found} == {r["page_id"]: len(r["text"]) for r in found}
    assert {r["page_id"] for r in found if not r["text"]} == set()


def test_quotes_in_tags_take_linear_time():
    start = time.monotonic()
    assert extract("<p " + "a='" * 20000 + ">x</p>", None, set()) is not None
    assert extract("<p " + "a=\"b\" c='d' " * 200000 + ">x</p>", None, set()) == "x"
    assert time.monotonic() - start < 20
