"""Pages whose markup is odd: names that only look like marks, end tags left out, very long broken pages."""

import time

import pytest

from fleetschema.llm import html

LONG = "A standfirst that is long enough to be prose, with a comma and a full stop at its very end."

CASES = {
    "<div class='layout has-sidebar'><article><p>Text one.</p></article></div>": ["Text one."],
    "<div class='content-with-sidebar'><main><p>Text one.</p></main></div>": ["Text one."],
    "<article><p class='search-results'>a b.</p><p id='side-effects'>c d.</p><div id='share-of-gdp'>e.</div><ul class='menu-of-day'><li>f</ul><p>g</article>": ["a b.", "c d.", "e.", "f", "g"],
    "<article><p class='ad'>buy<p>one<p>two</article>": ["one", "two"],
    "<article><ul><li class='share'>s<li>keep</ul><p>after</article>": ["keep", "after"],
    "<article><p>a<div class='share-buttons'><a>x</a><b>y</div><p>b</article><nav>n": ["a", "b"],
    "<article><div class='article-comments'><p>c1<p>c2</div><p>b</article>": ["b"],
    "<article><div class='ad-slot'><p>buy</article><p>out</p>": ["out"],
    f"<article><header><h1>T</h1><p>{LONG}</p><p>By X</p></header><p>b</article>": ["T", LONG, "b"],
    "<article><p>1 < 2 & 3 > 2 <b <i>x</i></p></article>": ["1 < 2 & 3 > 2 x"],
}


@pytest.mark.parametrize("page", CASES)
def test_odd_pages(page):
    assert html.main_text(page, None).split("\n\n") == CASES[page]


def test_long_broken_pages_take_seconds():
    pages = ["<a " * 300_000 + '"', '<a href="x' * 100_000, "<b>" * 50_000 + "<p>x</p>" * 50_000, "<div>" * 100_000 + "x", "<" * 1_000_000, "<p class='ad'>" * 70_000, "<script>" * 120_000]
    start = time.process_time()
    for page in pages:
        html.parse(page)
    assert time.process_time() - start < 30


def test_containers_of_any_depth_are_named():
    page = "<div class='x'>" * 150 + "<p>deep text, deep text, deep text.</p>" + "</div>" * 150
    assert html.main_text(page, None) == "deep text, deep text, deep text."
    assert max(len(n.path) for n in html.parse(page)[1]) < 1_000
