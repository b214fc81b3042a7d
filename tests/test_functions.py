"""Expected values of the text functions, worked out by hand or by small programs of our own."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from judgex.functions import amounts, citations, llmjson, paths, prompts, pytext, zones


def rows(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def mapped(spark, values, f, kind="string"):
    return [r[0] for r in rows(spark, values, kind).select(f(F.col("x"))).collect()]


AMOUNTS = {
    "叁万元": "30000", "二十万": "200000", "十万": "100000", "万元": "10000", "三千五元": "3005", "三千五": "", "一万亿元": "100000000", "一万亿": "1000000000000", "壹佰万圆整": "1000000",
    "1,234.50元": "1234.5", "3万5千元": "30000", "20万元": "200000", "0.5亿": "50000000", "-5": "5", "约12.30": "12.30", "１２": "１２", None: "", "": "", "两百零五": "",
}


def test_normalize(spark):
    assert mapped(spark, list(AMOUNTS), amounts.normalize) == list(AMOUNTS.values())


def test_normalize_local(spark):
    assert mapped(spark, ["20万", "0.5亿元", "1,200元", "叁万", "x"], amounts.normalize_local) == ["200000", "50000000", "1200", "", ""]


@pytest.mark.parametrize(
    "zone, text, best",
    [
        ("Z4", "被告应当偿还借款20万元。", "20"), ("Z4", "被告应当偿还借款二十万元。", "200000"), ("Z4", "双方确认0.5万元。", "10000"), ("Z4", "双方确认20,000元。", "0"), ("Z4", "受理费0.5万元由原告负担。", ""),
        ("Z4", "准许撤诉，受理费50元。", ""), ("Z4", "被告支付本金120000.50元", "120000.50"), ("Z4", "诉讼费用\n5万元归还", "10000"), ("Z3", "被告向原告借款50000元", "50000"),
        ("Z3", "利息3000元；冻结账户60000", "60000"), ("Z3", "标的60000", ""), ("Z4", None, ""), ("Z4", "  ", ""),
    ],
)
def test_best_amount(spark, zone, text, best):
    assert mapped(spark, [text], lambda x: amounts.best(x, zone)) == [best]


def test_match_offsets_are_code_points(spark):
    got = mapped(spark, ["😀a12b3", "", "x"], lambda x: pytext.matches(x, "[0-9]+"))
    assert [[(m.start, m.text) for m in g] for g in got] == [[(2, "12"), (5, "3")], [], []]


ZONE_TEXT = "（2023）民初1号张三与李四一案。经审理查明：借款。本院认为，应还。判决如下：还款。"


def test_anchors_and_partition(spark):
    r = rows(spark, [ZONE_TEXT, "", None, "无"]).select(zones.header_anchor("x").alias("a"), zones.verdict_anchor("x").alias("b"), zones.partition("x").alias("p")).collect()
    assert r[0].a == ZONE_TEXT.index("号") + 1 and r[0].b == ZONE_TEXT.index("：还款") + 1
    assert r[0].p.anchor_status == "ok" and "".join(z.text for z in r[0].p.zones) == ZONE_TEXT
    for x in (r[1], r[2]):
        assert x.p.anchor_status == "empty_or_unsplittable" and x.p.boundaries == [] and all((z.start, z.end, z.text) == (0, 0, "") for z in x.p.zones)
    assert r[3].p.anchor_status == "missing_anchor"


@pytest.mark.parametrize(
    "b, z1, z4, want, status",
    [([5, 12, 40, 45, 45, 50], 8, 30, [8, 12, 30, 30, 45, 50], "ok"), ([5, 6, 7, 25, 28, 50], 8, 30, [8, 6, 7, 30, 30, 50], "ok"), ([1, 2, 3, 4, 5, 6], 30, 8, [1, 2, 3, 4, 5, 6], "invalid_anchor_order")],
)
def test_anchored(spark, b, z1, z4, want, status):
    df = spark.createDataFrame([(b, z1, z4)], "b array<int>, z1 int, z4 int")
    got = df.select(*(c.alias(n) for c, n in zip(zones.anchored(F.col("b"), F.col("z1"), F.col("z4"), F.lit(50)), "ab"))).first()
    assert (got.a, got.b) == (want, status)
    fixed = df.select(zones.anchored(F.col("b"), F.col("z1"), F.col("z4"), F.lit(50), compat=False)[0].alias("a")).first().a
    assert status != "ok" or fixed == sorted(fixed)


def test_downsample(spark):
    got = rows(spark, [240, 300, 479, 480, 500, 720], "int").select(zones.downsample(F.sequence(F.lit(0), F.col("x") - 1)).alias("a")).collect()
    assert [(len(r.a), r.a[-1]) for r in got] == [(240, 239), (240, 239), (240, 239), (240, 478), (240, 478), (240, 717)]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text("。；：a 号判决如下\n😀　", max_size=30), min_size=150, max_size=150))
def test_boundaries_property(spark, texts):
    got = mapped(spark, texts, zones.boundaries)
    for t, b in zip(texts, got):
        assert b == sorted(set(b)) and b[0] == 0 and b[-1] == len(t)
        assert {i + 1 for i, ch in enumerate(t) if ch in "。；：\n" and (i + 1 == len(t) or t[i + 1] not in "。；：\n")} <= set(b)


def test_encoded(spark):
    v = F.create_map(F.lit("a"), F.lit(5))
    assert mapped(spark, ["a b", " ", "a" * 100], lambda x: zones.encoded(x, v, 1)) == [[5, 1], [1], [5] * 80]


def cites(*laws):
    return [(law, "第一条", "", 0.5) for law in laws]


@pytest.mark.parametrize(
    "laws, resolved, vague",
    [(["同法", "A", "同法", "B", ""], ["B", "A", "A", "B", "B"], []), (["A", "B", "A", "本法"], ["A", "B", "A", "A"], []), (["同法", "A", "B", "A"], ["B", "A", "B", "A"], []), (["同法", ""], [], ["同法", ""]), ([], [], [])],
)
def test_pronouns(spark, laws, resolved, vague):
    r = spark.createDataFrame([(cites(*laws),)], f"c array<{citations.CITATION}>").select(citations.resolved("c").alias("r")).first().r
    assert [c.law_name for c in r.resolved] == resolved and [c.law_name for c in r.ambiguous] == vague


def test_expected_articles(spark):
    (got,) = mapped(spark, ["依照《合同法》第六十条、第二百零六条、第六十条，《民诉法》第64条。第一条；《合同法》第九条"], citations.expected)
    assert [(e.law, e.articles) for e in got] == [("合同法", ["第九条"]), ("民诉法", ["第64条"])]


def test_normalized(spark):
    assert mapped(spark, ["Ａ 〈b〉　＜", None], citations.normalized) == ["A《b》<", ""]


def _tiers(text, law, article, span):
    """Alignment by tiers, as a plain program."""
    norm = lambda s: "".join(s.replace("〈", "《").replace("〉", "》").split())
    t, law, article, span = text, law.strip(), article.strip(), span.strip()
    hit = lambda x: x in t or norm(x) in norm(t)
    if not t:
        return False
    if span and hit(span):
        return True
    if not (law and article):
        return False
    arts = {article} | ({article[1:]} if article.startswith("第") else set())
    return hit(law) and any(hit(a) for a in arts)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(*(st.text("甲乙〈〉《》 第1条", max_size=6) for _ in range(4))), min_size=200, max_size=200))
def test_aligned_property(spark, cases):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, law string, article string, span string").orderBy("i")
    c = F.struct(F.col("law").alias("law_name"), "article", F.col("span").alias("source_span"))
    got = [r[0] for r in df.select(citations.aligned(F.col("t"), citations.normalized("t"), c)).collect()]
    assert got == [_tiers(*c) for c in cases]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(max_size=12).filter(lambda s: s.isprintable() or s.isascii()), min_size=100, max_size=100))
def test_json_string_property(spark, texts):
    texts = [t.replace("\x7f", "") for t in texts]
    assert mapped(spark, texts, pytext.json_string) == [json.dumps(t, ensure_ascii=False) for t in texts]


def test_list_repr(spark):
    lists = [["a", "b's", 'c"d', "e'f\"g", "\\n\n\u3000"], []]
    assert mapped(spark, lists, pytext.list_repr, "array<string>") == [repr(x) for x in lists]


def test_strip_is_unicode(spark):
    assert mapped(spark, ["\u3000 a b\xa0\n", "\x1c", None], pytext.strip) == ["a b", "", None]


def test_flat(spark):
    assert mapped(spark, ["a\r\nb\rc\nd"], pytext.flat) == ["a\\nb\\nc\\nd"]


ANSWERS = {
    '```json\n{"target_amount": "5万", "amount_type": "loan", "source_zone": "none"}\n```': ("50000", "涉案金额", "Z3"),
    'x {"a": {"b": 1} {"target_amount": 70, "amount_type": "?", "source_zone": "Z4"}': ("", "unknown", "none"),
    '{bad} {"target_amount": 70, "amount_type": "?", "source_zone": "Z4"} {}': ("70", "交付金额", "Z4"),
    "[1]": ("", "unknown", "none"), "": ("", "unknown", "none"), None: ("", "unknown", "none"),
}


def test_amount_answers(spark):
    assert [tuple(r) for r in mapped(spark, list(ANSWERS), llmjson.amount)] == list(ANSWERS.values())


def test_citation_answers(spark):
    c = '{"law_name": "A", "article": "1"}'
    texts = [f"[{c}]", f'x {{"citations": [{c}, {c}]}} y', "{broken", f"```\n[{c}]\n```", '{"other": 1}', None]
    assert [len(x) for x in mapped(spark, texts, llmjson.citations)] == [1, 2, 0, 1, 0, 0]


PATHS = {
    "/d/2014/abc.json": (("2014", "abc"), ("unknown", "abc"), "2014"), "/d/x/result_2013-05.csv.jsonl": (("2013", "2013-05"), ("unknown", "result_2013-05.csv"), "unknown_year"),
    "/d/2013-05.csv": (("2013", "2013-05"), ("2013", "2013-05"), "2013"), "a.csv": (("unknown", "a"), ("unknown", "a"), "unknown_year"),
}


def test_paths(spark):
    r = rows(spark, list(PATHS)).select(paths.year_month("x").alias("a"), paths.year_month_of_stem("x").alias("b"), paths.year_of_output("x").alias("c")).collect()
    assert [(tuple(x.a), tuple(x.b), x.c) for x in r] == list(PATHS.values())


def test_instruction_length():
    assert len(prompts.INSTRUCTION + prompts.AMOUNT_INSTRUCTION) == 123
