"""Main text of pages: names inside articles, broken markup, deep pages, densities by a plain model, edge rows."""

import math
import random
import time

import pytest

from rankloom.llm import html_text

PROSE = "".join(f"<p>{'word ' * 30}number {i}.</p>" for i in range(5))
LINES = [f"{'word ' * 30}number {i}." for i in range(5)]


def lines(page):
    return html_text.main_text(page).split("\n")


@pytest.mark.parametrize("whole", ["article", "main"])
@pytest.mark.parametrize(
    "out",
    ["<div class=cookies>We use cookies.</div>", "<div class=sponsor>By our sponsor.</div>", "<div class=advertising>Buy.</div>",
     "<div class=comment><p>I liked it.</p></div>", "<section id=replies><p>Me too, a reader.</p></section>",
     "<div class=notice>Please log in.</div>", "<div class=related><a href=x>More</a></div>", "<div id=comments><p>First!</p></div>"],
)
def test_notices_adverts_and_readers_inside_an_article_go(whole, out):
    assert lines(f"<body><{whole}>{PROSE}{out}</{whole}></body>") == LINES
    assert lines(f"<body><{whole}>{out}{PROSE}</{whole}></body>") == LINES


def test_names_of_sections_and_paragraphs_are_topics():
    own = "<section id=discussion><p>We discuss it.</p></section><section id=advertising><h2>Advertising</h2><p>They sold.</p></section><p class=notice>Note.</p>"
    assert lines(f"<article>{PROSE}{own}</article>") == [*LINES, "We discuss it.", "Advertising", "They sold.", "Note."]


def test_a_name_that_wraps_most_of_the_text_leaves_out_nothing():
    assert lines(f"<main><div class=notice>{PROSE}</div><p>Short.</p></main>") == [*LINES, "Short."]
    assert lines(f"<main><div class=overlay><article>{PROSE}</article></div></main>") == LINES


def test_the_innermost_article_wins_over_main():
    page = f"<main><article>{PROSE}</article><div class=author-bio>{'She writes. ' * 9}</div><div class=more>{'Read more. ' * 9}</div></main>"
    assert lines(page) == LINES
    assert lines(f"<main><h1>Title</h1><article>{PROSE}</article><div>{'Read more. ' * 9}</div></main>") == ["Title", *LINES]
    assert lines(f"<main><article>{PROSE}</article><article>{PROSE}</article><div>{'more ' * 9}</div></main>") == LINES * 2


def test_the_inside_of_what_is_left_out_closes_nothing():
    assert lines("<article><p>t<textarea><p>raw</textarea>after</p></article>") == ["tafter"]
    assert lines("<article><p>t<textarea></p></article>raw</textarea>after</p></article>") == ["tafter"]
    assert lines("<article><ul><li>a<noscript><li>b</noscript>c</ul></article>") == ["ac"]
    # An element that is never closed does not swallow what is outside its parent.
    assert lines(f"<body><div><nav><a href=x>x</a></div><article>{PROSE}</article></body>") == LINES


def test_deep_pages_take_time_in_proportion():
    for page in ("<div>" * 50_000 + "deep", "<p>a<table>" + "<div>" * 50_000 + "deep", "<ul><li>" * 25_000 + "deep", "<b>" * 50_000 + "deep</i>" * 100):
        start = time.perf_counter()
        assert "deep" in html_text.main_text(page)
        assert time.perf_counter() - start < 6


def random_page(depth):
    if depth == 0 or random.random() < 0.2:
        return "".join(random.choices("abcdef ", k=random.randrange(0, 40)))
    inner = "".join(random_page(depth - 1) for _ in range(random.randrange(1, 4)))
    tag = random.choice(["div", "div", "span", "a", "b"])
    return f"<{tag}>{inner}</{tag}>"


def plain_density(node, body_chars, body_links):
    """Density and density sum of a node by the definition, from its subtree each time."""

    def walk(n):
        yield n
        for c in n.children:
            if not isinstance(c, str):
                yield from walk(c)

    def chars(n, linked_only=False):
        return sum(len("".join(c.split())) for m in walk(n) if m.linked or not linked_only for c in m.children if isinstance(c, str))

    def formula(chars, tags, link_chars, link_tags):
        tags, links, link_tags = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + (body_links / body_chars if body_chars else 0) * chars + math.e)
        return chars / tags * max(math.log(chars / links * tags / link_tags), 0.0) / base

    def density(n):
        if not chars(n) or n.linked:
            return 0.0
        below = list(walk(n))[1:]
        return formula(chars(n), len(below), chars(n, True), sum(m.tag == "a" for m in walk(n)))

    own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
    total = sum(density(c) for c in node.children if not isinstance(c, str))
    return density(node), 0.0 if node.linked or not chars(node) else total + (formula(own, 0, 0, 0) if own else 0.0)


def test_densities_equal_a_plain_model():
    random.seed(8)
    for _ in range(60):
        tree = html_text.Tree()
        tree.feed(f"<body>{random_page(5)}</body>")
        tree.close()
        body = html_text._measure(tree)
        for node in tree.nodes:
            if node.tag in ("html", "body") and node is not body:
                continue
            density, total = plain_density(node, body.chars, body.link_chars)
            assert node.density == pytest.approx(density) and node.sum == pytest.approx(total)


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", f"<article>{PROSE}</article>"), (1, "u", f"<article>{PROSE}</article>"), (2, None, None), (None, "v", ""), (3, "w", "<p>é &amp; 😀"),
            (4, "x", "<div>" + "<p>" + "long " * 200_000 + "</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'kept' as text", "7 as n_chars")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert len(got) == 6 and [r.text for r in got if r.page_id == 1] == ["\n".join(LINES)] * 2
    assert {(r.page_id, r.text, r.n_chars) for r in got if r.page_id in (2, None)} == {(2, "", 0), (None, "", 0)}
    assert [r.text for r in got if r.page_id == 3] == ["é & 😀"] and all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(pages.limit(0)).count() == 0
