"""Parsing of broken pages: time grows with the length, and what is open is closed as before."""

import random
import time

import pytest

from bazaarlake.llm import html_extract

#: Pieces that once made time grow with the square of the page's length.
SOUP = {
    "tags without an end": "<a ",
    "quotes without an end": '<a b="',
    "stray end tags": None,
    "items": "<li>",
    "rules below a paragraph": None,
    "bold without an end": "<b>x",
    "nested drawings": "<svg><g>",
    "comments": "<!-- x",
    "nested blocks": "<div>x",
}


def soup(kind, size):
    if kind == "stray end tags":
        return "<div>" * (size // 10) + "</p>" * (size // 8)
    if kind == "rules below a paragraph":
        return "<p>a<div>" + "<x-y>" * (size // 10) + "<hr>" * (size // 8)
    if kind == "bold without an end":
        return "<b>x" * (size // 8) + "</i>" * (size // 8)
    return SOUP[kind] * (size // len(SOUP[kind]))


@pytest.mark.parametrize("kind", SOUP)
def test_a_megabyte_of_broken_markup(kind):
    html_extract.parse(soup(kind, 10_000))
    start = time.process_time()
    html_extract.parse(soup(kind, 1_000_000))
    assert time.process_time() - start < 8


def slow_shapes(page):
    """(tag, parent) of block elements by walking the stack for every end tag: elements of a small language only."""
    nodes, stack, at = [("html", -1)], [0], 0
    while (start := page.find("<", at)) >= 0:
        end = page.index(">", start)
        name, at = page[start + 1 : end], end + 1
        if name.startswith("/"):
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]][0] == name[1:]:
                    del stack[k:]
                    break
            continue
        for names in ([{"p"}] if name in html_extract.ENDS_P else []) + ([html_extract.CLOSES[name]] if name in html_extract.CLOSES else []):
            for k in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[k]][0]
                if tag in names:
                    del stack[k:]
                    break
                if tag in html_extract.SCOPES:
                    break
        nodes.append((name, stack[-1]))
        stack.append(len(nodes) - 1)
    return nodes


def test_what_is_open_is_closed_as_by_walking():
    rng = random.Random(3)
    names = "p div ul li table tr td section dt dd x-y h1".split()
    for _ in range(400):
        page = "".join(f"<{'/' if rng.random() < 0.35 else ''}{rng.choice(names)}>" for _ in range(rng.randrange(1, 60)))
        assert [(n.tag, n.parent) for n in html_extract.parse(page)] == slow_shapes(page)


def test_many_pages_still_give_a_sample(spark, monkeypatch):
    """The share of pages is cut finely enough for billions of them."""
    pages = spark.range(300).selectExpr("id AS page_id", "'u' AS url", "'<article><p>One. Two, three.</p></article>' AS html")
    rows = []
    monkeypatch.setattr(html_extract, "fit", lambda counted: rows.append(counted))
    html_extract.train(pages, sample=50)
    html_extract.train(pages.repartition(7), sample=50)
    assert rows[0] == rows[1] and 20 < rows[0]["tag article", 1] < 101
    assert int(1e-9 * 2000 * html_extract._FINE) > 0
