"""Main text of web pages by site style trees.

The pages of a host are merged into one style tree: a node stands for all elements with the same path of tags, classes
and ids (digits blotted out). Over the host's distinct pages, the entropy of a node's child tags (presentation) and of its
text (content) tells template from matter: a branch that shows nearly the same thing on page after page has low
importance, as has one outside articles whose text is mostly link text. Entropy is weighed against its evidence, as if some pages more had all
been different: a branch that never changes counts as template from ``least_pages`` pages on, one that hardly changes needs more, a list of links none.

The tree is built of all pages' whole bodies. A page's extraction walks its DOM and leaves out

* elements that hold no text of their own to read (head, scripts, styles, controls, comments in markup ...), and within a line these break no block;
* forms, headers of the body outside articles, mains and sections (fragments without a body have none), and branches whose tag, or a token of their role, class or id, says menu, header, footer, sidebar, notice, advert or
  reader comments. A fixed list has the words. A token of several words counts by its head: comment-list, site-header and leftSidebar do, share-price doesn't, nor do states
  like has-sidebar or nav-open. Spared are branches that such a token would drop though
  they hold over half of the page's text outside links (and an article or main element, if there is one outside such branches), or all of its article or main elements; and
* branches whose style node has low importance: elements that group others (div, section, table, list ...), never single paragraphs or headings.

Of what is left an article is the text if it holds a third of the page's text outside links (or half of the main element's, where that holds as
much); else the main element; else the body. So an article that is a teaser or a comment takes no one's place. In a fragment without a body an article
only gives way to an element that groups most of the text.

Nodes are counted by map-side combined aggregates on (host, path, looks), so a host with a third of all pages is no
hot task. The branches of low importance are broadcast while they are few (counted first); beyond that they are joined
to the nodes of the pages, by page.

Defined results: null html and pages without text give ""; null urls are one host; unclosed, misnested and stray
tags are repaired (paragraphs close each other, end tags without a start are ignored); elements with unknown names are part of a line; repeated rows and page_ids are
pages of their own; character references are decoded, white space in a block becomes one space, blocks are joined by one
newline; an empty table gives an empty result; further columns are ignored. Parsing takes time in proportion to the page, however its tags and quotes are nested or left open.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm.arrow import over, table
from judgex.session import cut

LEAST_PAGES, LOW = 8, 0.25
FEW = 20_000

#: Element names, by how they are treated. Other elements are parts of lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
SILENT = frozenset("head script style noscript template iframe object svg canvas audio video button select option textarea input nav footer aside dialog menu title noembed noframes annotation".split())
BLOCKS = frozenset(
    "#root html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr br legend li main menu nav ol optgroup "
    "p pre search section summary table caption colgroup tbody td tfoot th thead tr ul xmp".split()
)
#: Elements of lines whose end tags reach no further than the block they are in.
LINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
GROUPS = frozenset("div section ul ol dl table header figure center details fieldset blockquote".split())
SECTIONS = frozenset("article main section".split())
HEADINGS = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Words in a tag's class, id or role that mark what is no part of the article; those of them that a paragraph of an article may bear.
NOISE = frozenset(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus reply replies "
    "respond pagination pager toolbar complementary contentinfo search".split()
)
MILD = frozenset("header notice alert related recommended search widget".split())
#: What a noun may hold without changing what it is about, and words that make a token a state.
HOLDERS = frozenset("list slot box wrap wrapper container area section block bar item items panel holder inner content links unit thread feed tree group row col column left right top bottom main".split())
STATES = frozenset("has with no without is not open opened closed on off active enabled disabled visible hidden collapsed expanded".split())
#: Start tags that close an open element of the given names.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody"), "body": ("head",),
}
_P_STOP = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SCOPE = frozenset("article aside blockquote body button div footer form header html main nav section table td th ul ol".split())
_LISTS = frozenset({"ul", "ol", "dl", "table", "select"})
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_OPENS = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_QUOTE = re.compile(r"[>\"']")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")


class Node(NamedTuple):
    tag: str
    marks: tuple[str, ...]
    children: list


class _Tags:
    """Where the tags of a text end. Quotes that are left open, or hold what looks like tags, are looked at once."""

    def __init__(self, text: str):
        self.text, self.last = text, {c: text.rfind(c) for c in "\"'>"}
        self.astray: set[int] = set()  # quotes from which no way leads to a tag's end

    def end(self, start: int) -> int:
        """After the first > outside quotes, or else the first of all; 0 if there is none."""
        at, passed = start, []
        while m := _QUOTE.search(self.text, at) if at <= self.last[">"] else None:
            if m[0] == ">":
                return m.end()
            q = m.start()
            if q in self.astray or q >= self.last[m[0]]:
                break
            passed.append(q)
            at = self.text.index(m[0], q + 1) + 1
        self.astray.update(passed)
        return self.text.index(">", start) + 1 if start < self.last[">"] else 0


class _Open:
    """The open elements, with where each name, scope and list is open."""

    def __init__(self, root: Node):
        self.stack, self.at, self.scopes, self.lists = [root], {}, [], []

    def push(self, node: Node) -> None:
        i = len(self.stack)
        self.stack.append(node)
        self.at.setdefault(node.tag, []).append(i)
        for kinds, where in ((_SCOPE, self.scopes), (_LISTS, self.lists)):
            if node.tag in kinds:
                where.append(i)

    def pop(self) -> None:
        node = self.stack.pop()
        self.at[node.tag].pop()
        for kinds, where in ((_SCOPE, self.scopes), (_LISTS, self.lists)):
            if node.tag in kinds:
                where.pop()

    def close(self, names: tuple[str, ...], within: list[int] | None = None) -> None:
        """Close the innermost element of these names, and all in it, unless it is outside the innermost of ``within``."""
        i = max((w[-1] for n in names if (w := self.at.get(n))), default=0)
        if i and not (within and i < within[-1]):
            while len(self.stack) > i:
                self.pop()


def parse(text: str) -> Node:
    """The DOM: nodes and, as strings with references decoded, text."""
    root = Node("#root", (), [])
    tags, opened, at, raw = _Tags(text), _Open(root), 0, None
    stack, n = opened.stack, len(text)
    while at < n:
        if raw:
            m = re.compile(rf"</{raw}(?=[\s/>])[^>]*>", re.I).search(text, at)
            end, after = (m.start(), m.end()) if m else (n, n)
            if end > at:
                stack[-1].children.append(text[at:end])
            opened.pop()
            at, raw = after, None
            continue
        m, end = _OPENS.search(text, at), 0
        while m and not end:
            other = text[m.end()] in "!?"
            end = _OTHER.match(text, m.start()).end() if other else tags.end(m.start())
            if not end:  # nothing after it closes a tag
                m = re.compile(r"<[!?]").search(text, m.end())
        if not m:
            stack[-1].children.append(_html.unescape(text[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(_html.unescape(text[at : m.start()]))
        tok, at = text[m.start() : end], end
        if other:
            if tok.startswith("<![CDATA["):
                stack[-1].children.append(tok[9:].removesuffix("]]>"))
            continue
        name = _NAME.match(tok)[1].lower()
        if tok[1] == "/":
            if name == "br":
                stack[-1].children.append(Node("br", (), []))
            else:
                opened.close((name,), opened.scopes if name in LINE or name == "p" else None)
            continue
        if name in _P_STOP:
            opened.close(("p",), opened.scopes)
        if name in CLOSES:
            opened.close(CLOSES[name], opened.lists)
        marks: tuple[str, ...] = ()
        if len(tok) > len(name) + 2:
            marks = tuple(f"{k.lower()}={a or b or c}" for k, a, b, c in _ATTR.findall(tok))
        if name == "header" and not any(opened.at.get(x) for x in SECTIONS) and any(opened.at.get(x) for x in ("html", "body")):
            marks += ("role=banner",)  # what the element means in a body
        node = Node(name, marks, [])
        stack[-1].children.append(node)
        if name in VOID or tok.endswith("/>") and name not in RAW and name not in LINE | GROUPS | _P_STOP:
            continue
        opened.push(node)
        if name in RAW:
            raw = name
    return root


def step(node: Node) -> str:
    """A node's part of a style path."""
    return node.tag + "".join(sorted("." + re.sub(r"\d+", "#", m) for m in node.marks))


def tells(token: str) -> str:
    """The word of ``NOISE`` that a class, id or role is about, or ""."""
    low = token.lower()
    if low in NOISE:
        return low
    words = [w.lower() for w in _WORDS.findall(token)]
    if len(words) < 2 or STATES & set(words):
        return ""
    while len(words) > 1 and (words[-1] in HOLDERS or words[-1].isdigit()):
        words.pop()
    return words[-1] if words[-1] in NOISE else ""


def worded(node: Node) -> bool:
    """Whether an element is a form, or its class, id or role tells of a word of ``NOISE``; paragraphs and headings may bear milder ones."""
    if node.tag == "form":
        return True
    if not node.marks or node.tag in ("html", "body", "article", "main"):
        return False
    found = {tells(t) for m in node.marks for t in m.split("=", 1)[1].split()} - {""}
    return bool(found - MILD if node.tag in HEADINGS else found)


def spared(dom: Node) -> frozenset[int]:
    """ids of the elements that hold too much to be dropped by a word: most of the text outside links, or all articles (or mains).

    Beside an article that no word would drop, however short, most of the text is no reason.

    Forms count only the text of paragraphs and headings, so a page that is one form of labels stays empty.
    """
    order, todo, noise = [], [(dom, -1, False, False, False)], False
    while todo:
        x, up, linked, inside, told = todo.pop()
        at, word = len(order), worded(x)
        noise |= word
        linked, inside, told = linked or x.tag == "a", inside or word, told or x.tag in HEADINGS
        chars = 0 if linked else sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str))
        order.append([x, up, word, inside, chars, x.tag == "article", x.tag == "main", chars if told else 0])
        todo += [(c, at, linked, inside, told) for c in x.children if isinstance(c, Node) and c.tag not in SILENT]
    if not noise:
        return frozenset()
    open_ = [any(o[k] and not o[3] for o in order) for k in (5, 6)]  # an article, a main that no word would drop
    for o in reversed(order[1:]):
        up = order[o[1]]
        up[4] += o[4]
        up[5] |= o[5]
        up[6] |= o[6]
        up[7] += o[7]
    most = lambda o: 2 * o[7 if o[0].tag == "form" else 4] > order[0][4] and (o[5] or o[6] or not any(open_))
    return frozenset(id(o[0]) for o in order if o[2] and (most(o) or not any(open_) and (o[5] or o[6])))


def noisy(node: Node, spare: frozenset[int] = frozenset()) -> bool:
    """Whether a tag or its class, id or role says that it is no part of the article."""
    return node.tag in SILENT or worded(node) and id(node) not in spare


_paths: dict[str, int] = {}


def below(path: int, node: Node) -> int:
    """The style path of a node under that of its parent, as a hash of bounded size."""
    own = step(node)
    if len(_paths) > 1 << 16:
        _paths.clear()
    h = _paths.get(own)
    if h is None:
        h = _paths[own] = hash_text(own)
    h = K.mix1(K.mix1(path) + h)
    return h - (1 << 64) if h >> 63 else h


def looks(dom: Node) -> Iterator[tuple[int, int, int, int, int, bool]]:
    """(style path, hashes of child tags and text, link characters, characters, is it in an article) of the grouping elements that could be left out.

    Texts are compared by their characters other than white space. All elements' are ranges of one text, so each is looked at once.
    """
    spare, chunks, size, links = spared(dom), [], 0, 0
    out: list[list] = []
    todo: list = [(dom, 0, False, False, True)]
    while todo:
        x, path, linked, inside, judged = todo.pop()
        if isinstance(x, str):
            t = "".join(x.split()).encode("utf-8", "surrogatepass")
            chunks.append(t)
            size, links = size + len(t), links + len(t) * linked
        elif isinstance(x, int):
            out[x][2:4] = [size, links - out[x][3]]
        elif x.tag not in ("script", "style"):
            if x is not dom and x.tag in BLOCKS:
                path = below(path, x)
            inside |= x.tag in ("article", "main")
            judged &= x is dom or not noisy(x, spare)
            if judged and x.tag in GROUPS:
                todo.append((len(out), 0, False, False, False))  # when all below it is seen
                out.append([path, size, 0, links, hash_text(" ".join(k.tag for k in x.children if isinstance(k, Node))), inside])
            todo += [(c, path, linked or x.tag == "a", inside, judged) for c in reversed(x.children)]
    if out:
        starts, ends = (np.array([o[i] for o in out]) for i in (1, 2))
        texts = K.signed(K.RangeHash(np.frombuffer(b"".join(chunks), np.uint8))(starts, ends)).tolist()
        for (path, lo, hi, own, tags, inside), t in zip(out, texts):
            yield path, tags, t, own, hi - lo, inside


def kept(dom: Node, low: frozenset[int] | set[int] = frozenset()) -> tuple[list[Node], set[int]]:
    """(the elements that hold the main text, ids of the elements to leave out); ``low`` are the style paths of low importance."""
    spare, gone = spared(dom), set()
    prose: list[list] = []  # element, parent, characters outside links, in an article, in a main
    todo: list = [(dom, -1, 0, False, False, False)]
    while todo:
        x, up, path, linked, article, main = todo.pop()
        if x is not dom:
            if x.tag in BLOCKS:
                path = below(path, x)
            if noisy(x, spare) or x.tag in GROUPS and path in low:
                gone.add(id(x))
                continue
        at, linked = len(prose), linked or x.tag == "a"
        prose.append([x, up, 0 if linked else sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str)), article, main])
        article, main = article or x.tag == "article", main or x.tag == "main"
        todo += [(c, at, path, linked, article, main) for c in reversed(x.children) if isinstance(c, Node)]
    for p in reversed(prose[1:]):
        prose[p[1]][2] += p[2]
    articles = [p for p in prose if p[0].tag == "article" and not p[3]]
    mains = [p for p in prose if p[0].tag == "main" and not p[4] and not p[3]]
    held = lambda found: sum(p[2] for p in found)
    if mains and 3 * held(mains) >= prose[0][2]:
        inner = [p for p in articles if p[4]]
        return [p[0] for p in (inner if inner and 2 * held(inner) >= held(mains) else mains)], gone
    # loose paragraphs beside an article in a fragment make no body that could take its place
    elsewhere = any(p[0].tag in ("html", "body") or p[0].tag in GROUPS and not p[3] and 2 * p[2] > prose[0][2] for p in prose)
    return [p[0] for p in articles] if articles and (not elsewhere or 3 * held(articles) >= prose[0][2]) else [dom], gone


def main_text(dom: Node, low: frozenset[int] | set[int] = frozenset()) -> str:
    """The text of what remains, a block a line."""
    blocks, here = [], []

    def end() -> None:
        if t := " ".join("".join(here).split()):
            blocks.append(t)
        here.clear()

    roots, gone = kept(dom, low)
    for root in roots:
        todo: list = [(root, False)]
        while todo:
            x, closing = todo.pop()
            if isinstance(x, str):
                here.append(x)
                continue
            if x.tag in BLOCKS:
                end()
            if not closing and id(x) not in gone:
                todo.append((x, True))
                todo += [(c, False) for c in reversed(x.children)]
        end()
    return "\n".join(blocks)


def host_of(url: str | None) -> str:
    m = re.search(r"://([^/?#]*)", url or "")
    return m[1].lower() if m else ""


def _looks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows (host, path, tags, text, page, links, chars, inside): the looks of every judged element, as hashes."""
    for url, text in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
        if not text:
            continue
        dom = parse(text)
        if rows := list(looks(dom)):
            c = list(zip(*rows))
            n = len(rows)
            yield table(host=[host_of(url)] * n, page=pa.array([hash_text(main_text(dom))] * n, pa.int64()), **{k: pa.array(v, pa.bool_() if k == "inside" else pa.int64()) for k, v in zip(("path", "tags", "text", "links", "chars", "inside"), c)})


def hash_text(s: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def unimportant(pages: DataFrame, least_pages: int = LEAST_PAGES, low: float = LOW) -> DataFrame:
    """Rows (host, path, importance): the style nodes of low importance."""
    every = over(pages.select("url", "html"), _looks, "host string, page long, path long, tags long, text long, links long, chars long, inside boolean")
    # equal pages count once
    once = every.groupBy("host", "path", "page", "text", "tags").agg(F.max("links").alias("links"), F.max("chars").alias("chars"), F.max("inside").alias("inside"))
    once = cut(once, "style-looks")  # else both entropies would parse the pages

    def spread(what: str) -> DataFrame:
        n = once.groupBy("host", "path", what).agg(F.count(F.lit(1)).alias("n"), F.sum("links").alias("links"), F.sum("chars").alias("chars"), F.max("inside").alias("inside"))
        # entropy over its greatest value: sum(n) values that all differ
        h = F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")
        return n.groupBy("host", "path").agg(
            F.sum("n").alias("n"), (h / F.log(F.greatest(F.sum("n"), F.lit(2)))).alias(f"h_{what}"), F.sum("links").alias("links"), F.sum("chars").alias("chars"), F.max("inside").alias("inside")
        )

    content, style = spread("text"), spread("tags").select("host", "path", "h_tags")
    both = content.join(style, ["host", "path"])
    # as many pages that differ are added as leave a branch that never changes just above the limit one page before least_pages
    doubt = max(0.0, low * (least_pages - 1) / (1 - low) - 1e-9) if low < 1 else 0.0
    varied = (F.greatest("h_text", "h_tags") * (F.col("n") - 1) + F.lit(doubt)) / F.greatest(F.col("n") - 1 + F.lit(doubt), F.lit(1e-9))
    linked = F.when(F.col("inside"), F.lit(0.0)).otherwise(F.col("links") / F.greatest(F.col("chars"), F.lit(1)))
    return both.select("host", "path", (varied * (1 - linked)).alias("importance")).filter(F.col("importance") < low)


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, low: float = LOW, few: int = FEW) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one a page."""
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), "url", "html")
    bad = cut(unimportant(pages, least_pages, low), "style-nodes").select("host", "path")
    schema = "page_id long, url string, text string, n_chars long"
    if bad.limit(few + 1).count() <= few:
        known: dict[str, set[int]] = {}
        for host, path in bad.collect():
            known.setdefault(host, set()).add(path)
        shared = pages.sparkSession.sparkContext.broadcast(known)

        def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            urls = b.column("url").to_pylist()
            text = [main_text(parse(h), shared.value.get(host_of(u), frozenset())) if h else "" for u, h in zip(urls, b.column("html").to_pylist())]
            yield table(page_id=b.column("page_id"), url=b.column("url"), text=text, n_chars=[len(t) for t in text])

        return over(pages, f, schema)

    def paths(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [(k, host_of(u), p) for k, u, h in zip(*(b.column(c).to_pylist() for c in ("key", "url", "html"))) if h for p in {x[0] for x in looks(parse(h))}]
        if rows:
            c = list(zip(*rows))
            yield table(key=pa.array(c[0], pa.int64()), host=list(c[1]), path=pa.array(c[2], pa.int64()))

    keyed = pages.withColumn("key", F.xxhash64("url", "html"))
    mine = over(keyed, paths, "key long, host string, path long").join(bad, ["host", "path"]).groupBy("key").agg(F.collect_set("path").alias("low"))

    def g(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = [main_text(parse(h), set(p or ())) if h else "" for h, p in zip(b.column("html").to_pylist(), b.column("low").to_pylist())]
        yield table(page_id=b.column("page_id"), url=b.column("url"), text=text, n_chars=[len(t) for t in text])

    return over(keyed.join(mine, "key", "left").select("page_id", "url", "html", "low"), g, schema)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
