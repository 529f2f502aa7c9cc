"""Main text: cuts against all labellings of small graphs, pages by hand, the query against the articles of the table."""

import html
import itertools
import random
import re

import pytest

from daybook.llm import html_text
from daybook.llm.layouts import labelled_pages
from daybook.llm.queries import QUERIES


def weight(costs, edges, side):
    return (sum(max(0, -c) if s else max(0, c) for c, s in zip(costs, side))
            + sum(w for a, b, w in edges if side[a] != side[b]))


def test_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 9)
        costs = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) * rng.random() for _ in range(n)]
        edges = [(a, b, rng.random() * rng.choice([0.3, 1, 2])) for a in range(n) for b in range(a) if rng.random() < 0.5]
        best = min(weight(costs, edges, side) for side in itertools.product([False, True], repeat=n))
        assert weight(costs, edges, html_text.minimum_cut(costs, edges)) == pytest.approx(best)


LONG = "A paragraph of the story with quite a few words in it, so that it reads like one."
PAGES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>" + LONG, LONG),
    (f"<nav>Home About</nav><div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><footer>(c)</footer>", f"{LONG} Yes. {LONG}"),
    (f"<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{LONG}</main>", f"Title {LONG}"),
    (f"<article><p>{LONG}<aside>More</aside><form>Mail <input></form><div class='comments'><p>{LONG}</p></div></article>", LONG),
    (f"<article><p title='a>b'>a &lt;b&gt; c &amp;&nbsp;d\n\n e</p><script>var t='</p>';</script><p>{LONG}</article>", f"a <b> c & d e {LONG}"),
    (f"<div class='cookie-notice'>{LONG}</div><div id=content><ul><li>One<li>Two</ul>{LONG}</div>", f"One Two {LONG}"),
    ("<article>fo<b>o</b> <i>bar</i><br>x</article>", "foo bar x"), ("<article><p>a<script>never ends", "a"),
    (f"<article>{LONG}<!-- no --><![CDATA[x]]> 1 < 2</article>", f"{LONG} 1 < 2"),
    (f"<ul class='menu'>{'<li><a href=x>Link</a>' * 30}</ul><table><tr><td>{LONG}<td>{LONG}</table>", f"{LONG} {LONG}"),
]


PAGES += [
    (f"<div id='header'><a href=/>Logo</a></div><div><div class='left sidebar'><h3>Popular</h3><ul><li>{LONG}</ul></div><div class='text'>"
     f"<h1>Title here</h1><p>{LONG}</p><p>{LONG} {LONG}</p><ul><li>Item one</li><li>Item two</li></ul><blockquote>{LONG}</blockquote>"
     f"<p>Short.</p></div></div><div id='comments'><p>{LONG}</p></div><div class='foot'>Copyright 2020 Company</div>",
     f"Title here {LONG} {LONG} {LONG} Item one Item two {LONG} Short."),
    (f"<div><a href=a>One</a> | <a href=b>Two</a> | <a href=c>Three</a></div><h1>Heading of page</h1><p>{LONG}</p><p>{LONG}</p>"
     f"<p><a href=x>Read more</a></p><p>{LONG}</p><div>&copy; 2020 Foo</div>", f"Heading of page {LONG} {LONG} {LONG}"),
    (f"<header><nav><a>A</a></nav></header><main><h1>T</h1><p>{LONG}</p><figure><img><figcaption>Caption words</figcaption></figure>"
     f"<table><tr><th>H</th><td>1</td></tr></table><pre>code  x</pre><section class='comments'><p>{LONG}</p></section></main><aside>{LONG}</aside>",
     f"T {LONG} Caption words H 1 code x"),
    (f"<div class='cookie-consent'><p>{LONG}</p></div><div role='main'><p>{LONG}</p></div><div role='contentinfo'>x {LONG}</div>", LONG),
]


#: Names that sound like boilerplate on what holds the article.
PAGES += [(f"<div {names}><h1>A title of it</h1><p>{LONG}</p><p>{LONG}</p></div>", f"A title of it {LONG} {LONG}") for names in [
    'class="no-sidebar"', 'class="entry-content has-sidebar"', 'class="post share-enabled"', 'class="article legal"', 'class="content with-comments"',
    'class="main widget-off"', 'id="page" class="js-search"', 'class="wrapper noSidebar"', 'class="article comments-open"']]
PAGES += [(f"<article><h1>T</h1><p>{LONG}</p><h2 id={name}>Its heading</h2><p>{LONG}</p></article>", f"T {LONG} Its heading {LONG}")
          for name in ("legal", "search", "form", "share", "alert", "menu")]
PAGES += [(f"<article><h1>T</h1><p>{LONG}</p><section id={name}><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></section></article>", f"T {LONG} Head {LONG} {LONG}")
          for name in ("discussion", "search", "legal", "form", "share", "social", "related", "notice", "alert")]
PAGES += [
    (f"<article><p>Take <math><mi>x</mi></math> here</p><p>{LONG}</p></article>", f"Take x here {LONG}"),
    (f"<div>{LONG} {LONG}</div><div>{LONG} {LONG}</div>", f"{LONG} {LONG} {LONG} {LONG}"),
    (f"<h1>Head</h1>{LONG} {LONG}<br><br>{LONG}", f"Head {LONG} {LONG} {LONG}"),
    (f"<div class=x><div class=y><h1>Head</h1><div>{LONG}</div><div>{LONG}</div></div><div class=z><a href=q>Foo bar</a></div></div>", f"Head {LONG} {LONG}"),
    (f"<div hidden><p>{LONG}</p></div><article><p style='display: none'>{LONG}</p><p>{LONG}</p></article>", LONG)]


def test_costs_hold_on_other_layouts():
    """Pages that the costs were not fitted on: their blocks' own labels, and after the cut whole pages."""
    weights, right, blocks, exact = html_text.fitted(), 0, 0, 0
    for page, content in labelled_pages(200, html_text.SEED + 1):
        found = html_text.blocks_of(page)[0]
        blocks += len(found)
        right += sum((html_text._cost(block, weights) > 0) == (block.text in content) for block in found)
        exact += html_text.main_text(page) == " ".join(block.text for block in found if block.text in content)
    assert right > 0.97 * blocks and exact > 0.93 * 200


def test_names_weigh_less_than_text():
    """No name alone settles a block: in an article, a paragraph under any fitted name but those of comments and the like stays."""
    weights = html_text.fitted()
    assert all(abs(weight) < 20 for weight in weights.values())
    assert weights["name:legal"] < 0 < weights["name:legal of text"] + weights["in:article"]


@pytest.mark.parametrize("page, text", PAGES)
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_pages():
    for page in ["<div>" * 50_000 + "</p>" * 50_000, "<select>" * 20_000, "<a b=\"" * 20_000, "<" * 100_000, "<p>" + "word " * 200_000,
                 "".join(f"<div><p>word {i}</p></div>" for i in range(5_000)), "<p>&amp" * 20_000]:
        html_text.main_text(page)
    assert html_text.main_text("<article>" + "<p>ab</p>" * 20_000 + "</article>").count("ab") == 20_000


def test_operator(frame):
    rows = [(i, "u", page, "x") for i, (page, _) in enumerate(PAGES)] + [(None, None, None, None), (0, "u", None, "x")]
    out = html_text.extract(frame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(out) == len(rows)
    assert all(row.text == dict(enumerate(t for _, t in PAGES)).get(row.page_id, "") and row.n_chars == len(row.text) for row in out)
    assert html_text.extract(frame([], "page_id long, url string, html string")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = {row.page_id: row.text for row in QUERIES["op6_html_extraction"](spark, folder).collect()}
    for page in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        assert got[page.page_id] == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
