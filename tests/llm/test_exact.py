"""The operators against SQL, brute force, round trips or held-out accuracy."""

import collections
import hashlib
import itertools
import math
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from judgex.llm import classifier, decontamination, html, jaccard, kernels, quality, queries, spans, suffixes, urls, warc
from judgex.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLES[name])


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, near copies, shared passages, periodic and symbol-laden texts."""
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdefghéü", k=rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(w + (rng.choice([".", ",", "!\n", ".\n"]) if rng.random() < 0.12 else "") for w in rng.choices(vocab, k=n))

    texts = [prose(rng.randint(1, 260)) for _ in range(50)]
    passage = prose(90)
    for i in range(10):
        texts.append(prose(40) + "\n" + passage + "\n" + prose(30))
    for i in range(30):
        w = texts[rng.randrange(50)].split(" ")
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [texts[0], texts[1], texts[1], "a b " * 400, "x" * 900, "", None, "A a", "one"]
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)], SCHEMA).repartition(3)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_brute_force(corpus, k, percent):
    sets = {}
    for r in corpus.collect():
        w = WORD.findall((r.text or "").translate(LOWER))
        sets[r.doc_id] = frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(corpus, jaccard.Rule(k, percent)).collect()}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}
    if k == 5:
        assert jaccard.first_of_each(corpus, jaccard.Rule(k, percent)).count() == len({find(d) if s else -d - 1 for d, s in sets.items()})


def test_jaccard_blocks(corpus, monkeypatch):
    want = {r.doc_id: r.component_id for r in jaccard.link(corpus, jaccard.Rule(1, 60)).collect()}
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    assert {r.doc_id: r.component_id for r in jaccard.link(corpus, jaccard.Rule(1, 60)).collect()} == want


def test_parts_agree_by_pigeonhole():
    rng = np.random.default_rng(1)
    for percent in (60, 80, 90):
        rule = jaccard.Rule(3, percent)
        for _ in range(300):
            n = int(rng.integers(1, 400))
            a = kernels.mix(rng.integers(0, 1 << 60, n))
            drop = int(rng.integers(0, n // 8 + 1))
            b = np.unique(np.concatenate((a[drop:], kernels.mix(rng.integers(0, 1 << 60, int(rng.integers(0, n // 8 + 1)))))))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
                keys = [np.concatenate([jaccard.part_keys(u, rule, j) for j in jaccard._bands(len(u), rule)]) for u in (a, b)]
                assert len(np.intersect1d(*keys))


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(200)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.v: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[v] == find(v) for p in pairs for v in p if p[0] != p[1])


@pytest.mark.parametrize("size", [400, 230])
def test_suffixes_brute_force(corpus, size):
    rows = [(r.doc_id, (r.text or "").encode()) for r in corpus.collect()]
    seen = collections.Counter(t[p : p + size] for _, t in rows for p in range(len(t) - size + 1))
    got = {r.doc_id: r for r in suffixes.remove(corpus, size).collect()}
    for d, t in rows:
        gone = np.zeros(len(t) + 1, int)
        for p in range(len(t) - size + 1):
            if seen[t[p : p + size]] > 1:
                gone[p : p + size] = 1
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept, got[d].kept_sha256) == (len(t), len(t) - len(kept), runs, kept, hashlib.sha256(kept).hexdigest())


def _sentence_ends(text):
    """(words, which of them end a sentence), told from the rule and not from the operator's code."""
    found = list(WORD.finditer(text))
    words = [m[0].translate(LOWER).encode() for m in found]
    data = np.frombuffer(b"".join(words), np.uint8)
    edge = np.cumsum([0, *map(len, words)])
    h = kernels.RangeHash(data)(edge[:-1], edge[1:]).tolist() if words else []
    last = [re.search(r"[.!?][^\x80-\U0010ffffa-zA-Z0-9]*$", m[0]) is not None for m in found]
    for i, (m, n) in enumerate(zip(found, found[1:])):
        last[i] |= "\n" in text[m.end() : n.start()]
    for i in range(len(h) - spans.GAP + 1):
        own = h[i : i + spans.GAP]
        last[i + max(k for k, x in enumerate(own) if x == min(own))] = True
    if last:
        last[-1] = True
    return words, last


def test_spans_brute_force(corpus):
    """Every run of sentences that is long enough, not only those that the operator hashes."""
    places, size = collections.defaultdict(list), {}
    for d, t, rid in corpus.select("doc_id", "text", F.xxhash64("doc_id", "text")).collect():
        words, last = _sentence_ends(t or "")
        edge = [0, *(i + 1 for i, x in enumerate(last) if x)]
        size[d] = len(edge) - 1
        for i, j in itertools.combinations(range(len(edge)), 2):
            if j - i >= spans.RUN and edge[j] - edge[i] >= spans.WORDS:
                places[tuple(words[edge[i] : edge[j]])].append((d, rid, i, j))
    gone = collections.defaultdict(set)
    for p in places.values():
        for d, _, i, j in sorted(p)[1:]:
            gone[d] |= set(range(i, j))
    got = {r.doc_id: (r.n_sentences, r.n_removed) for r in spans.report(corpus).collect()}
    assert got == {d: (n, len(gone[d])) for d, n in size.items()}


def test_passages_go_from_all_but_one(spark):
    passage = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu nu xi. Omicron pi rho sigma tau upsilon. Phi chi psi omega one two three four five."
    unique = [f"This is document number {i} with words{i} of its own {i * 7}. Nothing here comes twice at all, it is {i}." for i in range(6)]
    docs = spark.createDataFrame([(i, f"{u}\n{passage}\n{u[::-1]}", "en", "s") for i, u in enumerate(unique)], SCHEMA)
    got = {r.doc_id: r.text for r in spans.strip(docs).collect()}
    assert got[0].count("Omicron pi") == 1 and all("Omicron pi" not in got[i] and unique[i] in got[i] for i in range(1, 6))


def test_base_stats_brute_force(corpus):
    for b in corpus.toArrow().to_batches():
        for s in kernels.slabs(b.column("text"), 3000):
            got = quality.base_stats(s)
            for i, t in enumerate(b.column("text").slice(s.lo, s.n).to_pylist()):
                t = t or ""
                w = WORD.findall(t)
                three = collections.Counter(zip(w, w[1:], w[2:]))
                cover = {j for i_ in range(len(w) - 2) if three[tuple(w[i_ : i_ + 3])] > 1 for j in range(i_, i_ + 3)}
                lines = [x for x in t.split("\n") if WORD.search(x)]
                want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))
                assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_fertility_measures():
    v = quality.load()
    enc = quality._encoding(v)
    for text in ("Hello world, hello", "äöü\n𝔘", "a"):
        c, f, e = quality.fertility(text, enc, v.singles)
        ids = enc.encode_ordinary(text)
        p = [n / len(ids) for n in collections.Counter(ids).values()]
        assert c == len(text) / len(ids) and abs(e + sum(x * math.log2(x) for x in p)) < 1e-9 and 0 <= f <= 1
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=f"{quality.TOKENIZERS}/{quality.PIECES}")
    text = "straße \n𝔘 ok"
    assert round(quality.fertility(text, enc, v.singles)[1] * len(text.encode())) == sum(sp.is_byte(i) for i in sp.encode(text))


def test_classifier_holds_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum((x.predicted == 1) == (x.quality == 1) for x in r) >= 0.9 * len(r)


def test_isotonic():
    x, y = classifier.isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 0, 1, 1.0]))
    assert list(y) == sorted(y) and len(x) == len(y)


def test_decontamination_brute_force(spark):
    rng = random.Random(9)
    vocab = ["ab", "Cd", "e1", "ü", "x"]
    make = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "-", "... "]) for _ in range(n))
    items = [(i, make(rng.randint(0, 20))) for i in range(25)]
    docs = [(i, make(rng.randint(0, 60)) + (rng.choice(items)[1] if i % 3 else ""), "en", "s") for i in range(60)]
    toks = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    want = {}
    for d, t, *_ in docs:
        w, hit, found = toks(t), set(), set()
        for item, text in items:
            q = toks(text)
            m = min(13, len(q))
            wins = {tuple(q[i : i + m]) for i in range(len(q) - m + 1)} if m else set()
            for i in range(len(w) - m + 1 if m else 0):
                if tuple(w[i : i + m]) in wins:
                    hit |= set(range(i, i + m))
                    found.add(item)
        want[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    got = decontamination.scan(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_viterbi():
    counts = {"cheap": 50, "pills": 40, "the": 900, "che": 2, "a": 300, "pill": 5, "s": 100}
    assert urls.viterbi("cheappills", counts, 10_000) == ["cheap", "pills"]
    assert urls.viterbi("zzz", counts, 10_000) == ["zzz"] and urls.viterbi("", counts, 10) == []
    for name in ("thecheappill", "atheas"):
        every = []
        for cuts in itertools.product([0, 1], repeat=len(name) - 1):
            words, cur = [], name[0]
            for c, ch in zip(cuts, name[1:]):
                words, cur = (words + [cur], ch) if c else (words, cur + ch)
            words.append(cur)
            score = sum(math.log(counts[w] / 10_000) if w in counts else math.log(10 / 10_000) - len(w) * math.log(10) for w in words)
            every.append((score, words))
        best = max(every)[0]
        got = urls.viterbi(name, counts, 10_000)
        assert abs(next(s for s, w in every if w == got) - best) < 1e-9


def test_spam_hosts_are_blocked(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    r = urls.judge(pages).filter("rule is null").select("host", "verdict").distinct().collect()
    bad = re.compile("spam|casino|pills|bets|adult|ads-")
    assert all((x.verdict == "block") == bool(bad.search(x.host)) for x in r)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    bodies = [b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nab\n\nfiledesc://x 1 2 3 4\n", b"", b"plain \xff\n"]
    data = warc.arc_head(version, "n", "20200102030405") + b"".join(warc.arc_record(version, "n", f"http://h/a b{i}", "20200102030405", c) for i, c in enumerate(bodies))
    got = list(warc.arc_records(data))
    assert [r.content for r in got] == bodies and [r.url for r in got] == [f"http://h/a%20b{i}" for i in range(3)] and {r.name for r in got} == {"n"}
    assert list(warc.arc_records(data[:-3]))[-1].truncated
    packed = warc._member(data[:50]) + warc._member(data[50:]) + warc._CLOSING + b"\0"
    assert warc.unpacked(packed) == data
    record = warc.converted(got[0], None)
    ((fields, block),) = warc.warc_records(record)
    assert block == bodies[0] and fields["warc-date"] == "2020-01-02T03:04:05Z" and fields["warc-payload-digest"] == "sha1:" + warc.base32_sha1(b"ab\n\nfiledesc://x 1 2 3 4\n")


def test_main_text_is_the_article(spark):
    import html as std

    for r in html.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(std.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner))
        assert r.text == "\n".join(b for b in blocks if b)


def test_templates_without_marks_go(spark):
    page = lambda i: f"<html><body><div class=top><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></div><div class=main><h1>Title {i}</h1><p>Body text {i} &amp; more {i * i}</p></div><div class=end>All rights reserved</div></body></html>"
    pages = spark.createDataFrame([(i, f"http://h.org/{i}", page(i)) for i in range(30)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == {i: f"Title {i}\nBody text {i} & more {i * i}" for i in range(30)}
    assert {r.page_id: r.text for r in html.extract(pages, few=0).collect()} == got


@pytest.mark.parametrize(
    "source, text",
    [
        ("<p>a<b>b<p>c</b>d", "ab\ncd"), ("<ul><li>a<li>b</ul>c", "a\nb\nc"), ("a<!-- x<p> -->b", "ab"), ("<script>var t='</p>';</script>a", "a"), ("<td>1<td>2", "1\n2"), ("a < b & c &amp;lt; &#x41;", "a < b & c &lt; A"),
        ("<article>x<div class='comments'>y</div></article>z", "x"), ("<main>m<aside>n</aside></main>o", "m"), ("</div>a</p>b", "ab"), ("<p title='a>b'>c", "c"), ("<header>h</header><p>t", "h\nt"), ("<pre> a\n  b</pre>", "a b"),
    ],
)
def test_parser(source, text):
    assert html.main_text(html.parse(source)) == text


@pytest.mark.parametrize("marks", [".", ""])
def test_passages_inside_sentences_go(spark, marks):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, passages = [], []
    for i in range(60):
        passage = [word() + (marks if rng.random() < 0.1 else "") for _ in range(51)]
        passages.append(passage)
        for d in range(2):
            around = [word() for _ in range(rng.randint(5, 20) * 2)]
            half = len(around) // 2
            rows.append((2 * i + d, " ".join(around[:half] + passage + around[half:]), "en", "s"))
    got = {r.doc_id: set(r.text.split()) for r in spans.strip(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, p in enumerate(passages):
        assert set(p) <= got[2 * i] and sum(w not in got[2 * i + 1] for w in p) > len(p) / 2


def test_spans_cover_all_repeated_runs(spark):
    rng = random.Random(4)
    pool = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(rng.randint(1, 14))) + "." for _ in range(60)]
    rows = []
    for i in range(40):
        at, n = rng.randrange(50), rng.randint(2, 10)
        rows.append((i, " ".join([f"own{i} start.", *pool[at : at + n], f"own{i} end."]), "en", "s"))
    docs = spark.createDataFrame(rows, SCHEMA)
    places, size = collections.defaultdict(list), {}
    for d, t, *_ in rows:
        w, _, begin = spans.sentences(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        words = t.split()
        edge = [*begin.tolist(), len(words)]
        size[d] = len(begin)
        for i, j in itertools.combinations(range(len(begin) + 1), 2):
            if j - i >= spans.RUN and edge[j] - edge[i] >= spans.WORDS:
                places[tuple(words[edge[i] : edge[j]])].append((d, i, j))
    gone = collections.defaultdict(set)
    for p in places.values():
        for d, i, j in sorted(p)[1:]:
            gone[d] |= set(range(i, j))
    assert {r.doc_id: (r.n_sentences, r.n_removed) for r in spans.report(docs).collect()} == {d: (n, len(gone[d])) for d, n in size.items()}


@pytest.mark.parametrize("mark", ["layout has-sidebar", "with-header", "nav-open", "no-comments", "social-share-on", "page sidebar"])
def test_wrappers_named_after_template_parts_stay(mark):
    body = "<p>Body of the article, with words enough.</p><div class='menu'>Home</div><div class='x comments'>Reply</div>"
    for inner in (f"<article>{body}</article>", f"<main>{body}</main>", body):
        page = f"<body><div class='{mark}'>{inner}</div><div class='footer'>Rights</div></body>"
        assert html.main_text(html.parse(page)) == "Body of the article, with words enough."
    assert html.main_text(html.parse("<div class='comments'><article>c</article></div><article>longer text</article>")) == "longer text"


def test_long_words_of_hosts_are_found(spark):
    word = "donaudampfschifffahrtsgesellschaft"
    page = f"<p>{word} {word} free " * 3
    r = urls.judge(spark.createDataFrame([(1, f"http://free{word}.org/", page)], "page_id long, url string, html string")).first()
    assert r.words == ["free", word] and urls.viterbi("z" * 40, {"a": 1}, 100) == ["z" * 40]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<body><div><article>a</article><article>b</article></div><article>c", "a\nb\nc"),
        ("<body><header>Site</header><div><p>one two</div>", "one two"),
        ("<body><article><header><h1>T</h1></header><p>x</article>", "T\nx"),
        ("<body><section><header>T</header><p>x</section>", "T\nx"),
        ("<body><form><h1>T</h1><p>long enough text<p>more<input></form>", "T\nlong enough text\nmore"),
        ("<body><form><article>x</article></form>", "x"),
        ("<body><form><label>Name</label><button>go</button></form>", ""),
        ("<body><p>some text here</p><form><p>search</form>", "some text here"),
        ("<body><article><p class=header>h</p><p>x</article>", "h\nx"),
    ],
)
def test_page_furniture(source, text):
    assert html.main_text(html.parse(source)) == text


def test_rare_clean_hosts_are_allowed(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    clean = ["downloads.org", "beethoven.org", "alphabet.org", "www.essex.gov.uk", "news.gardening.org", "www.universityoftoronto.org", "physics.org"]
    spam = ["bestcasino.org", "cheap-pills.org"]
    more = spark.createDataFrame([(-1 - i, f"https://{h}/about", "<p>x") for i, h in enumerate(clean + spam)], pages.schema)
    got = {r.host: r.verdict for r in urls.judge(pages.unionAll(more)).filter("page_id < 0").collect()}
    assert got == {h: "allow" for h in clean} | {h: "block" for h in spam}


def test_token_weights_by_hand():
    seen = np.array([[90.0, 9, 1, 0, 0], [5, 0, 0, 5, 0]])
    p, v, n = seen.sum(0) / seen.sum(), 4, seen.sum(1)
    want = [math.log((seen[1, k] + v * p[k]) / (n[1] + v)) - math.log((seen[0, k] + v * p[k]) / (n[0] + v)) for k in range(4)]
    got = urls.token_weights(seen)
    assert np.allclose(got, [*want, 0]) and got[2] < 0 < got[3]
    assert not urls.token_weights(np.zeros((2, 3))).any()
