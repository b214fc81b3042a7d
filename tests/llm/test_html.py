"""Main text: what counts as template, where articles give way, odd markup in linear time, importance against brute force."""

import collections
import math
import random
import time

import pytest

from judgex.llm import html


def _text(source, low=frozenset()):
    return html.main_text(html.parse(source), low)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # reader comments go, inside an article too
        ("<body><article><p>The text.</p><div class=comment-list>c1</div><ul id=user-comments><li>c2</ul><section class='article__comments'>c3</section></article>", "The text."),
        # compound names count by their head
        ("<body><div class=site-header>a</div><div class=main-nav>b</div><div class=left-sidebar>c</div><p>Text of the page.</p><div class=comment-list>d</div><div class=ad-slot>e</div><div id=siteFooter>f</div>", "Text of the page."),
        ("<body><div class=share-price>Prices rose.</div><p class=search-results>Found.</p><div class=header-image>Fig.</div>", "Prices rose.\nFound.\nFig."),
        ("<body><div class='nav-open has-sidebar no-comments'><p>Text</p></div><div class=ads3>x</div>", "Text"),
        # an article that is a comment or a teaser takes no one's place
        ("<body><main>The text of the main.</main><article>a comment</article>", "The text of the main."),
        ("<body><main><p>Lead.</p><article>Most of the text is in here, as it should be.</article></main>", "Most of the text is in here, as it should be."),
        ("<body><article>more</article><div><p>The text of the page stands here.</p></div>", "more\nThe text of the page stands here."),
        ("<body><div class=ad>A long advert beside a short article, much longer than that.</div><article>Short.</article>", "Short."),
        # what stands in a line doesn't break it
        ("<p>Press <button>OK</button> to see <math><mi>x</mi><mo>=</mo><mn>2</mn></math> now<svg><text>s</text></svg>.</p>", "Press to see x=2 now."),
        ("<p>a <my-tag>b</my-tag> <script>c</script>d</p>", "a b d"),
        # paragraphs may bear mild words
        ("<article><p class=alert>It alerts.</p><p class=related>Related.</p><p class=advert>Buy.</p></article>", "It alerts.\nRelated."),
    ],
)
def test_what_stays(source, text):
    assert _text(source) == text


@pytest.mark.parametrize(
    ("token", "word"),
    [("comments", "comments"), ("comment-list", "comment"), ("siteHeader", "header"), ("main_nav", "nav"), ("sidebar-left", "sidebar"), ("ad-box-2", "ad"), ("has-sidebar", ""), ("nav-open", ""), ("share-price", ""), ("shares", ""), ("adsense", ""), ("list", ""), ("box", "")],
)
def test_tokens(token, word):
    assert html.tells(token) == word


N = 16_000


@pytest.mark.parametrize(
    "source",
    ["<div>" * N + "</x>" * N, "<b>" + "<i>" * N + "</b>" * N, "<a '" * N, '<a ">" ' * N, "<a '" * N + ">", '<a "' * N + ">" * N, "<div>" * N + "x", "".join(f"<div class='a{i}b'>t" for i in range(N)), "<a " * N, "<!" * N, "<ul><li>" * N, "<div><p>" * N, "<script>" * N, "<a " + "class = " * N + ">"],
    ids=range(14),
)
def test_time_is_linear(source):
    began = time.process_time()
    dom = html.parse(source)
    list(html.looks(dom))
    html.main_text(dom)
    assert time.process_time() - began < 5


def test_quotes_as_the_rule_says():
    """The tag's end is the first > outside quotes, or else the first of all."""
    rng = random.Random(3)

    def slow(text, start):
        quote = None
        for i in range(start, len(text)):
            if quote:
                quote = None if text[i] == quote else quote
            elif text[i] == ">":
                return i + 1
            elif text[i] in "\"'":
                quote = text[i]
        return text.find(">", start) + 1

    for _ in range(3000):
        text = "<" + "".join(rng.choices("a<>'\" ", k=rng.randint(0, 14)))
        tags = html._Tags(text)
        assert [tags.end(i) for i, c in enumerate(text) if c == "<"] == [slow(text, i) for i, c in enumerate(text) if c == "<"], text


def _pages(n, same=0.5, seed=1):
    """Pages of two hosts without any marks: a menu of links, a block that stays the same on some pages, and text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    for i in range(n):
        often = "All rights reserved by us" if rng.random() < same else f"Other words {word()}"
        menu = "".join(f"<li><a href=/{x}>{x}</a>" for x in ("Home", "About", "Contact"))
        body = f"<div class=one><ul>{menu}</ul></div><div class=two><h1>{word()}</h1><p>{' '.join(word() for _ in range(30))}</p><div class=three>{word()} {word()}</div></div><div class=four>{often}</div>"
        yield (i, f"http://h{i % 2}.org/{i}", f"<html><body>{body}</body></html>")


@pytest.mark.parametrize("least", [1, 8])
def test_importance_brute_force(spark, least):
    pages = [*_pages(40), *list(_pages(40))[:10]]  # some come twice
    low = 0.7
    seen = collections.defaultdict(dict)
    for _, url, source in pages:
        dom = html.parse(source)
        page = html.main_text(dom)
        for path, tags, _, links, chars, inside in html.looks(dom):
            text = "".join(_under(dom, path))
            seen[html.host_of(url), path].setdefault((page, text, tags), (links, chars, inside))
    want = {}
    for key, found in seen.items():
        n = len(found)

        def h(values):
            c = collections.Counter(values)
            return -sum(x / n * math.log(x / n) for x in c.values()) / math.log(max(n, 2))  # noqa: B023

        doubt = max(0.0, low * (least - 1) / (1 - low) - 1e-9)
        most = max(h([k[1] for k in found]), h([k[2] for k in found]))
        varied = (most * (n - 1) + doubt) / max(n - 1 + doubt, 1e-9)
        value = varied * (1 - sum(x[0] for x in found.values()) / max(sum(x[1] for x in found.values()), 1))
        if value < low:
            want[key] = round(value, 9)
    got = {(r.host, r.path): round(r.importance, 9) for r in html.unimportant(spark.createDataFrame(pages, "page_id long, url string, html string"), least, low).collect()}
    assert got == want and want


def _under(dom, path):
    """Characters but white space of the elements with a style path, by a plain walk."""

    def walk(x, at, on):
        for c in x.children:
            if isinstance(c, str):
                if on:
                    yield "".join(c.split())
            else:
                down = html.below(at, c) if c.tag in html.BLOCKS else at
                yield from walk(c, down, on or down == path and c.tag in html.GROUPS)

    return walk(dom, 0, False)


def test_the_tree_decides(spark):
    pages = spark.createDataFrame(list(_pages(30, same=1.0)), "page_id long, url string, html string")
    with_tree = {r.page_id: r.text for r in html.extract(pages).collect()}
    without = {i: _text(source) for i, _, source in _pages(30, same=1.0)}
    assert all("rights" not in t and "Home" not in t and t.count("\n") == 2 for t in with_tree.values())
    assert all("rights" in t and "Home" in t for t in without.values())


def test_small_hosts_have_menus_too(spark):
    """Evidence is weighed, not asked for: one page shows that a block is all links, few pages don't show that text is template."""
    pages = spark.createDataFrame(list(_pages(4, same=1.0)), "page_id long, url string, html string")
    got = [r.text for r in html.extract(pages).collect()]
    assert all("Home" not in t and "rights" in t for t in got)


def test_link_lists_of_articles_stay(spark):
    source = "<html><body><article><p>See these.</p><ul><li><a href=/1>first source</a><li><a href=/2>second source</a></ul></article></body></html>"
    pages = spark.createDataFrame([(i, "http://a.org/", source.replace("these", f"these {i}")) for i in range(3)], "page_id long, url string, html string")
    assert all("first source" in r.text for r in html.extract(pages).collect())
