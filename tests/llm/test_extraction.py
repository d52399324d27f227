"""Main text of pages whose main text is known."""

import random

import pytest

from chartspark.llm import extraction

SENTENCE = "The quick brown fox jumps over the lazy dog, and nobody minds it at all."


def paragraphs(n, seed=0):
    pick = random.Random(seed)
    return [" ".join(SENTENCE.split()[: pick.randrange(6, 15)]) + f" Number {i}." for i in range(n)]


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style></head><body>{body}</body></html>"


MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(6)) + "</ul></nav>"
LINKS = '<div class="x1"><ul>' + "".join(f'<li><a href="/{i}">Some other story {i}</a></li>' for i in range(8)) + "</ul></div>"


def test_article_between_menus():
    texts = paragraphs(5)
    body = f"{MENU}<div class='ad'>Buy now, this is a long advert text. {SENTENCE}</div><article><h1>Head line</h1>" + "".join(
        f"<p>{t}</p>" for t in texts
    ) + "</article><footer>&copy; me</footer>"
    assert extraction.main_text(page(body)) == " ".join(["Head line", *texts])


@pytest.mark.parametrize("n", [1, 2, 9])
def test_blocks_without_article(n):
    texts = paragraphs(n, n)
    body = f'<div id="header"><a href="/">Home</a> Site name</div>{LINKS}<div id="x"><div class="story"><h2>Title of it</h2>' + "".join(
        f"<p>{t} <a href='/a'>link</a></p>" for t in texts
    ) + f'</div></div><div class="side-bar sidebar">{SENTENCE}</div><div id="comments"><p>{SENTENCE} {SENTENCE}</p></div>'
    assert extraction.main_text(page(body)) == " ".join(["Title of it", *(f"{t} link" for t in texts)])


def test_parts_dropped_inside_an_article():
    body = (
        f"<main><article><header><h1>Head</h1></header><p>{SENTENCE}</p><aside>Aside {SENTENCE}</aside><form><p>{SENTENCE}</p>"
        f"<input name=a><button>Go</button></form><script>var p = '<p>no</p>';</script><p>Two &amp; three &lt;b&gt;.</p>"
        f"<div class='share-buttons'>Share {SENTENCE}</div><noscript>off</noscript><!-- <p>no</p> --><p>Last <b>bo</b>ld</p></article></main>"
    )
    assert extraction.main_text(page(body)) == f"Head {SENTENCE} Two & three <b>. Last bold"


def test_other_articles_are_left_out():
    body = (
        f"<header>Site <a href=/>home</a></header><main><h1>Title</h1><article><p>{SENTENCE}</p><p>{SENTENCE}</p>"
        f"<section id='comments'><article class='comment'><p>{SENTENCE} I disagree.</p></article></section></article>"
        f"<article class='comment'><p>{SENTENCE} Me too.</p></article></main>"
        f"<div class='related'><article><p>{SENTENCE} {SENTENCE} {SENTENCE}</p></article></div>"
    )
    assert extraction.main_text(page(body)) == f"Title {SENTENCE} {SENTENCE}"
    two = f"<main><article><h2>A</h2><p>{SENTENCE}</p><p>{SENTENCE}</p></article><article><h2>B</h2><p>Short one.</p></article></main>"
    assert extraction.main_text(page(two)) == f"A {SENTENCE} {SENTENCE}"


def test_broken_markup():
    body = "<article><h1>One</h1><p><b>Two words.<br><p>Three</b> four<ul><li>five<li>six</ul><p>seven</article><p>"
    assert extraction.main_text(page(body)) == "One Two words. Three four five six seven"
    assert extraction.main_text("<p>open <b>bold") == "open bold"
    assert extraction.main_text("plain &eacute; text\n\t more") == "plain é text more"
    assert extraction.main_text("<div>a < b and <3 c</div>").startswith("a < b")


def test_entities_white_space_and_tables():
    body = "<article><p>a&nbsp;b&#8211;c   d\n\te</p><table><tr><td>x<td>y<tr><td>z</table><pre>k  l</pre></article>"
    assert extraction.main_text(page(body)) == "a b–c d e x y z k l"


def test_nothing_to_extract():
    for text in ("", " ", "<html></html>", page(""), page("<script>x</script>"), page(MENU), "<", "<!--", "</p>"):
        assert extraction.main_text(text) in ("", "<")


def test_long_and_deep_pages():
    many = page("<article>" + f"<p>{SENTENCE}</p>" * 20_000 + "</article>")
    assert extraction.main_text(many) == " ".join([SENTENCE] * 20_000)
    deep = page("<div>" * 5_000 + SENTENCE)
    assert extraction.main_text(deep) == SENTENCE


def test_rows(spark):
    rows = [(1, "u", page(f"<article><p>{SENTENCE}</p></article>"), 5), (1, None, None, 5), (None, "v", "", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = {(r.key, r.url): (r.text, r.n_chars) for r in extraction.extract(frame).collect()}
    assert found == {(1, "u"): (SENTENCE, len(SENTENCE)), (1, None): ("", 0), (None, "v"): ("", 0)}
    assert extraction.extract(frame.limit(0)).count() == 0


def test_all_given_pages(spark):
    """The given pages have their main text in an article of headings and paragraphs."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extraction.extract(pages).join(pages.select("page_id", "html"), pages.page_id == extraction.F.col("key")).collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split("</?(?:h1|p)>", re.sub("</?b>", "", body.replace("<br>", " ")))
        assert r.text == " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


TEXT = "The main text of this page goes on for a while, with several words in every sentence of it. " * 4


@pytest.mark.parametrize("open_, close", [
    ('<div class="content with-sidebar">', "</div>"),
    ('<div id="page-no-sidebar">', "</div>"),
    ('<section class="post has-share-buttons"><article>', "</article></section>"),
    ('<div class="search-and-content"><main>', "</main></div>"),
    ('<form action="/go">', "</form>"),
    ('<div class="no-ads"><div class="has-sidebar">', "</div></div>"),
    ('<div data-id="ad" data-role="banner">', "</div>"),
])
def test_wrappers_named_after_what_stands_beside_the_text(open_, close):
    page = f"<body><nav><a href=x>home</a></nav>{open_}<p>{TEXT}</p><div class=sidebar><p>beside it</p></div>{close}<footer>end</footer></body>"
    assert extraction.main_text(page) == TEXT.strip()


def test_marks_beside_the_text_stay():
    for marked in ('<div class="comments"><article><p>{}</p></article></div>', '<div class="sidebar"><p>{}</p></div>'):
        page = f"<body><article><p>{TEXT}</p></article>{marked.format('What a reader says. ' * 9)}</body>"
        assert extraction.main_text(page) == TEXT.strip()
    assert extraction.main_text(f"<body><p>{TEXT}</p><form><p>Your name, please.</p></form></body>") == TEXT.strip()


def test_lists_of_links_inside_an_article_stay():
    links = "".join(f"<li><a href=/{i}>Source {i}</a></li>" for i in range(5))
    assert extraction.main_text(page(f"{MENU}<article><p>{TEXT}</p><ul>{links}</ul><p>{TEXT}</p></article>")) == (
        f"{TEXT.strip()} {' '.join(f'Source {i}' for i in range(5))} {TEXT.strip()}"
    )


MEGABYTE = 1 << 20


@pytest.mark.parametrize("text", [
    "<a " * (MEGABYTE // 3), '<a "x ' * (MEGABYTE // 6), '<a b="x ' * (MEGABYTE // 8), "<header>" * (MEGABYTE // 8), "<p title='x>" * (MEGABYTE // 12),
    "<div>" * 100_000 + "</zz>" * 100_000, "<i><div>" + "<b>" * 150_000 + "</i>" * 100_000, "<div>" * 60_000 + "<li>" * 100_000,
    "<p>" * (MEGABYTE // 3), "<b><p>" * (MEGABYTE // 6), "<p " + "a= " * (MEGABYTE // 3) + ">", "<p " + " " * MEGABYTE + ">", "<!-" * (MEGABYTE // 3),
    "<script>" * (MEGABYTE // 8), "</p>" * (MEGABYTE // 4), "<table><tr><td>" * (MEGABYTE // 15),
])
def test_time_does_not_grow_with_the_square_of_a_broken_page(text):
    """Small parts of these pages took seconds when every open quote was looked for again; the limit is wide."""
    import time

    began = time.process_time()
    extraction.main_text(text)
    assert time.process_time() - began < 15


def test_tags_as_they_are_written():
    assert extraction.main_text("<p title='a > b'>one</p><p title=\"c > d\" x='>'>two</p><p data=a\"b>three</p>") == "one two three"
    assert extraction.main_text("<p>it is</p><p title=\"never closed>so</p><p>what</p>") == "it is so what"
    assert extraction.main_text("<p>whole</p><p class='") == "whole"


def plain_density(tree):
    """The sum over the children's densities, from the counts of each node alone, by walking the tree again for each."""
    import math
    import re

    def nodes(node):
        yield node
        for c in node.children:
            if not isinstance(c, str):
                yield from nodes(c)

    def chars(node):
        return sum(len(re.sub(r"\s+", " ", c).strip()) if isinstance(c, str) else chars(c) for c in node.children)

    def density(node, page_ratio):
        size, tags = chars(node), max(1, sum(1 for _ in nodes(node)) - 1)
        links = [n for n in nodes(node) if n.name == "a"]
        link_size, link_tags = sum(map(chars, links)), max(1, len(links))
        if not size:
            return 0.0
        base = math.log(size / max(1, size - link_size) * link_size + page_ratio * size + math.e)
        return size / tags * max(0.0, math.log(size / max(1, link_size) * tags / link_tags) / math.log(base) if base > 1 else math.log(size / max(1, link_size) * tags / link_tags))

    ratio = sum(map(chars, [n for n in nodes(tree) if n.name == "a"])) / max(1, chars(tree))
    return {id(n): density(n, ratio) for n in nodes(tree)}


@pytest.mark.parametrize("seed", range(6))
def test_density_from_the_definition(seed):
    pick = random.Random(seed)

    def block(depth):
        inner = "".join(pick.choice([SENTENCE[: pick.randrange(70)], "<a href=/x>link it</a>", "<b>bo</b>", "<br>"]) for _ in range(pick.randrange(5)))
        return f"<div>{inner}{''.join(block(depth - 1) for _ in range(pick.randrange(3)) if depth)}</div>"

    body = extraction.parse(block(4) + block(3))
    expected = plain_density(body)
    order = extraction._measured(body)
    ratio = body.link_chars / body.chars if body.chars else 0.0
    assert {id(n) for n in order} == set(expected)
    for node in order:
        assert extraction._density(node, ratio) == pytest.approx(expected[id(node)])
