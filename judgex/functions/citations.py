"""Law citations: normalising, pronouns, alignment with the text, completeness. Native but for NFKC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from judgex.functions.pytext import col, let, nfkc, squeeze, strip

#: Words that stand for a law named before.
PRONOUNS = ("同法", "本法", "该法", "本条例", "该条例", "本规定", "该规定")
COURT = "最高人民法院"
TITLE = "[《〈]([^》〉]+)[》〉]"
ARTICLE = r"第[一二三四五六七八九十百千零〇两\p{Nd}]+条"
CITATION = "struct<law_name:string,article:string,source_span:string,confidence:double>"


def brackets(c: Column | str) -> Column:
    return F.translate(col(c), "〈〉＜＞", "《》《》")


def normalized(c: Column | str, already_nfkc: bool = False) -> Column:
    """Text for comparison: NFKC, one kind of title brackets, no white space; "" for null."""
    c = F.coalesce(col(c), F.lit(""))
    return squeeze(brackets(c if already_nfkc else nfkc(c)))


def _field(c: Column, name: str) -> Column:
    return strip(F.coalesce(c[name], F.lit("")))


def aligned(text: Column, text_normal: Column, c: Column, normal=lambda x: squeeze(brackets(x))) -> Column:
    """Whether a citation is found in its text.

    Its span is in the text, or a form of its law's name and a form of its article both are; each as written or normalised.
    ``normal`` normalises the citation's own fields (inside array functions Python can't run, so without NFKC).
    """
    span, law, article = _field(c, "source_span"), _field(c, "law_name"), _field(c, "article")
    found = lambda x: F.contains(text, x) | F.contains(text_normal, normal(x))
    named = law != ""
    short = F.regexp_replace(law, f"\\A{COURT}", "")
    variants = [law, F.when(law.startswith(COURT), F.regexp_replace(short, "\\A[关于]+", "")), F.when(law.startswith(COURT), F.regexp_replace(law, f"\\A{COURT}关于", "关于"))]
    law_found = F.lit(False)
    for v in variants:
        law_found = law_found | F.coalesce((v != "") & found(v), F.lit(False))
    article_found = found(article) | (article.startswith("第") & found(F.regexp_replace(article, "\\A第", "")))
    return F.coalesce((text != "") & (((span != "") & found(span)) | (named & (article != "") & law_found & article_found)), F.lit(False))


def resolved(citations: Column | str) -> Column:
    """struct<resolved, ambiguous>: citations whose law is a pronoun or missing get the law named before.

    Before any is named, that is the law whose first mention comes last in the list; without any named law they are ambiguous.
    """
    a = col(citations)
    named = lambda n: (n != "") & ~n.isin(*PRONOUNS)
    vague = lambda c: let(_field(c, "law_name"), lambda n: ~named(n))

    def of(p: Column) -> Column:
        a, seed = p["a"], F.coalesce(F.try_element_at(p["explicit"], F.lit(-1)), F.lit(""))
        law_at = lambda i: F.element_at(F.concat(F.array(seed), F.filter(F.slice(p["names"], F.lit(1), i + 1), named)), -1)
        done = F.transform(a, lambda c, i: F.when(vague(c), c.withField("law_name", law_at(i))).otherwise(c))
        nothing = F.slice(a, 1, 0)
        none_named = F.size(p["explicit"]) == 0
        return F.struct(F.when(none_named, nothing).otherwise(done).alias("resolved"), F.when(none_named, F.filter(a, vague)).otherwise(nothing).alias("ambiguous"))

    with_names = let(F.struct(a.alias("a"), F.transform(a, lambda c: _field(c, "law_name")).alias("names")), lambda p: F.struct(p["a"].alias("a"), p["names"].alias("names"), F.array_distinct(F.filter(p["names"], named)).alias("explicit")))
    return let(with_names, of)


def cleaned(citations: Column | str) -> Column:
    """Distinct (law_name, article) pairs with both, stripped, in order of first mention."""
    pairs = F.transform(col(citations), lambda c: F.struct(_field(c, "law_name").alias("law_name"), _field(c, "article").alias("article")))
    return F.array_distinct(F.filter(pairs, lambda p: (p["law_name"] != "") & (p["article"] != "")))


def expected(text: Column | str) -> Column:
    """array<struct<law, articles>>: what a text cites. Articles follow a title until the next title or the sentence's end; of a law
    named twice the last mention with articles counts, in the place of the first such mention."""
    t = F.coalesce(col(text), F.lit(""))
    titles, parts = F.regexp_extract_all(t, F.lit(TITLE), F.lit(1)), F.split(t, TITLE, -1)
    segments = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda s: F.regexp_extract(s, "\\A[^。；;]*", 0))
    found = F.zip_with(titles, segments, lambda law, s: F.struct(law.alias("law"), F.array_distinct(F.regexp_extract_all(s, F.lit(ARTICLE), F.lit(0))).alias("articles")))
    found = F.filter(found, lambda x: F.size(x["articles"]) > 0)
    laws = F.array_distinct(F.transform(found, lambda x: x["law"]))
    return F.transform(laws, lambda law: F.struct(law.alias("law"), F.element_at(F.filter(found, lambda x: x["law"] == law), -1)["articles"].alias("articles")))


def issues(text: Column | str, citations: Column | str) -> Column:
    """array<struct<law, articles_in_text, articles_in_citations>> of laws with two articles or more, of which fewer were extracted."""
    c = F.coalesce(col(citations), F.array().cast(f"array<{CITATION}>"))

    def got(law: Column) -> Column:
        own = F.filter(c, lambda x: F.coalesce(x["law_name"], F.lit("")) == law)
        return F.array_distinct(F.filter(F.transform(own, lambda x: x["article"]), lambda a: F.coalesce(a, F.lit("")) != ""))

    rows = F.transform(expected(text), lambda e: F.struct(e["law"].alias("law"), e["articles"].alias("articles_in_text"), got(e["law"]).alias("articles_in_citations")))
    return F.filter(rows, lambda r: (F.size(r["articles_in_text"]) >= 2) & (F.size(r["articles_in_citations"]) < F.size(r["articles_in_text"])))
