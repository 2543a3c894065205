"""Main text of pages: cuts against brute force, made pages, and the query's own check."""

import html
import itertools
import random
import re

import pytest
from llm_cases import rows_of

from tillhouse.llm import main_text, queries

LONG = "This is a whole sentence of the article, with a comma and enough words to count as prose."


@pytest.mark.parametrize("seed", range(60))
def test_cut_has_the_least_cost(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    costs = [rng.randint(-9, 9) * 2 for _ in range(n)]
    edges = [(a, b, rng.randint(1, 9)) for a in range(n) for b in range(a) if rng.random() < 0.5]
    labels = main_text.cut(costs, edges)
    best = min(cost_of(x, costs, edges) for x in itertools.product([False, True], repeat=n))
    assert cost_of(labels, costs, edges) == best


def cost_of(labels, costs, edges):
    terminals = sum(max(c, 0) if not label else max(-c, 0) for label, c in zip(labels, costs, strict=True))
    return terminals + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_flow_is_sent_where_no_block_is_sure():
    costs = [5, -3, 4, -3, 5, -6]
    edges = [(i, i + 1, 4) for i in range(5)] + [(0, 2, 1)]
    labels = main_text.cut(costs, edges)
    best = min(cost_of(x, costs, edges) for x in itertools.product([False, True], repeat=6))
    assert cost_of(labels, costs, edges) == best
    assert main_text.source_side({0: 5, 1: -2}, [{1: 1}, {0: 1}]) == {0}


PAGES = {
    "semantic": (
        "<html><head><title>t</title><style>p{}</style></head><body><header>Site <a href=/>home</a></header>"
        "<nav><ul><li><a href=/a>A</a></li></ul></nav><main><article><h1>Head &amp; line</h1>"
        f"<p>{LONG}</p><aside>Also read this</aside><p>Short.</p></article>"
        "<section class='comments'><p>" + LONG + "</p></section></main><footer>&copy; us</footer></body></html>",
        ["Head & line", LONG, "Short."],
    ),
    "named": (
        f"<body><div id=topBar class='site-menu'><a href=x>one</a> <a href=y>two</a></div><div class='post-content'>"
        f"<h2>Part</h2><p>{LONG}<p>{LONG} Twice.<ul><li>{LONG}</li></ul></div>"
        f"<div class='cookie-notice'>{LONG}</div><form><p>{LONG}</p></form></body>",
        ["Part", LONG, f"{LONG} Twice.", LONG],
    ),
    "damaged": (
        f"<article><p>a<b>b<br>c&nbsp;&lt;d&gt;\n\n e</b>f<p>{LONG}<script>var x='</p><p>no';</script>"
        "<!-- <p>no</p> --> after</article><script>never closed <p>no</p>",
        ["ab c <d> ef", f"{LONG} after"],
    ),
    "plain": ("no markup at all, only words that follow each other on one line.",
              ["no markup at all, only words that follow each other on one line."]),
}


@pytest.mark.parametrize("name", PAGES)
def test_made_pages(name):
    page, expected = PAGES[name]
    assert main_text.main_text(page, {}).split("\n") == expected


def test_learned_traits_decide_where_elements_are_silent(spark):
    teaching = [
        (i, "u", f"<nav><ul><li><a href=/>link {i}</a></li><li><a href=/>more</a></li></ul></nav>"
                 f"<article><p>{LONG}</p><p>{LONG} {LONG}</p></article>") for i in range(20)
    ]
    odds = main_text.train(spark.createDataFrame(teaching, "page_id bigint, url string, html string"))
    page = (f"<body><div><a href=/>all</a></div><div><a href=/>of</a> <a href=/>it</a></div>"
            f"<div>{LONG}</div><div>{LONG} Again.</div><div><a href=/>next</a></div></body>")
    assert main_text.main_text(page, odds).split("\n") == [LONG, f"{LONG} Again."]


def test_awkward_rows(spark):
    rows = [(1, "a", None), (None, None, ""), (2, "b", "<p"), (3, "c", "<article>" + "<p>word, word." * 20_000),
            (3, "c", "<article>" + "<p>word, word." * 20_000), (4, "d", "<a '" * 2000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr(
        "*", "'clash' as text", "1 as n_chars")
    found = main_text.extracted(pages, main_text.train(pages))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    by_row = rows_of(found, "page_id", "n_chars")
    whole = 20_000 * len("word, word.") + 19_999
    assert by_row.count((3, whole)) == 2 and (None, 0) in by_row and (1, 0) in by_row
    empty = pages.limit(0)
    assert main_text.extracted(empty, main_text.train(empty)).count() == 0


def by_hand(page):
    """The article of the given pages, whose markup is always of one form."""
    article = re.search(r"<article>(.*?)</article>", page, re.DOTALL).group(1)
    pieces = re.split(r"</?(?:p|h1)>", article)
    texts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", p)).split()) for p in pieces]
    return "\n".join(t for t in texts if t)


def test_query_on_the_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in queries.table(spark, folder, "pages").collect()}
    found = {r.page_id: r for r in queries.op11_main_text(spark, folder).collect()}
    assert found.keys() == pages.keys()
    assert all(found[i].text == by_hand(page) and found[i].n_chars == len(found[i].text)
               for i, page in pages.items())
