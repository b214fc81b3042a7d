"""Splitting a judgment into seven zones: anchors, sentence boundaries, boundary repair, zone structs. All native.

The boundary model is pluggable: any function from a text column to an array of six boundary offsets. ``rule_boundaries`` is the default;
a trained one can be a pandas UDF over ``sentence_slices``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions.pytext import SPACE, col, filled, let

#: Zone names in order.
ZONES = ("Z1_Header", "Z2_Preamble", "Z3_Fact", "Z4_Reasoning", "Z5_Judgment", "Z6_Footer", "Z7_SignOff")
#: Marks after which a sentence ends; the header's last character and where it is looked for; limits.
ENDS = "。！？!?；;：:、\\n"
HEADER_END, HEADER_CHARS = "号", 100
MAX_SENTENCES, MAX_CHARS = 240, 80
_S = f"[{SPACE}]*"
VERDICT = f"(?:判{_S}决{_S}如{_S}下|如{_S}下{_S}判{_S}决){_S}[:：]?"


def header_anchor(text: Column | str) -> Column:
    """End of the header: after the last 号 of the first 100 characters; null without one."""
    head = F.substring(col(text), 1, HEADER_CHARS)
    at = F.instr(F.reverse(head), HEADER_END)
    return F.when(at > 0, F.length(head) - at + 1)


def verdict_anchor(text: Column | str) -> Column:
    """End of the first phrase that announces the verdict; null without one."""
    found = F.regexp_substr(col(text), F.lit(VERDICT))
    # an earlier copy of the found text would have matched itself, so instr finds the same place
    return F.when(found.isNotNull(), F.call_function("instr", col(text), found) - 1 + F.length(found))


def boundaries(text: Column | str) -> Column:
    """Sorted distinct candidate offsets: 0, sentence ends, anchors, the length; [0] for an empty text."""

    def of(t: Column) -> Column:
        pieces = F.regexp_extract_all(t, F.lit(f"[^{ENDS}]*[{ENDS}]+|[^{ENDS}]+"), F.lit(0))
        ends = F.aggregate(pieces, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p))))
        anchors = F.filter(F.array_compact(F.array(header_anchor(t), verdict_anchor(t))), lambda p: p > 0)
        return F.array_sort(F.array_distinct(F.concat(ends, anchors)))

    return let(F.coalesce(col(text), F.lit("")), of)


def slices(bounds: Column | str) -> Column:
    """Pairs of neighbouring boundaries, as array<struct<start, end>>."""

    def of(b: Column) -> Column:
        rest = F.slice(b, F.lit(2), F.greatest(F.size(b) - 1, F.lit(0)))
        return F.transform(rest, lambda e, i: F.struct(F.get(b, i).alias("start"), e.alias("end")))

    return let(col(bounds), of)


def downsample(sentences: Column | str, most: int = MAX_SENTENCES) -> Column:
    """At most ``most`` entries: every (n // most)-th, cut off at the limit."""

    def of(a: Column) -> Column:
        step = F.greatest(F.lit(1), F.floor(F.size(a) / most).cast("int"))
        return F.when(F.size(a) <= most, a).otherwise(F.slice(F.filter(a, lambda x, i: i % step == 0), 1, most))

    return let(col(sentences), of)


def monotonic(bounds: Column, length: Column) -> Column:
    """Running maximum from 0, each clamped to the length."""
    upto = lambda b, i: F.array_max(F.slice(b, F.lit(1), i + 1))
    return let(bounds.cast("array<int>"), lambda b: F.transform(b, lambda x, i: F.least(length.cast("int"), F.greatest(F.lit(0), upto(b, i)))))


def anchored(bounds: Column, z1: Column, z4: Column, length: Column, compat: bool = True) -> tuple[Column, Column]:
    """(boundaries, status): six boundaries forced to the anchors where both exist in order.

    With ``compat`` the first boundary may end up beyond the second, as in the reference results; else those are raised to it.
    """
    status = F.when(z1.isNull() | z4.isNull(), "missing_anchor").when(~((z1 > 0) & (z1 < z4) & (z4 <= length)), "invalid_anchor_order").otherwise("ok")
    at = lambda b, i: F.get(b, F.lit(i))
    clamped = F.array(*(F.least(length, F.greatest(F.lit(0), x)).cast("int") for x in (z1, at(bounds, 1), at(bounds, 2), z4, at(bounds, 4), at(bounds, 5))))
    # nothing left of the verdict beyond it, then a running maximum
    left = lambda b: F.array(*(F.least(*(at(b, j) for j in range(i, 4))) if i < 3 else at(b, i) for i in range(6)))
    high = lambda b: F.transform(b, lambda x, i: F.array_max(F.slice(b, F.lit(1), i + 1)))

    def reset(b: Column) -> Column:
        first, fourth = z1.cast("int"), z4.cast("int")
        middle = [at(b, i) if compat else F.least(F.greatest(at(b, i), first), fourth) for i in (1, 2)]
        return F.array(first, *middle, fourth, F.greatest(at(b, 4), fourth), F.greatest(at(b, 4), at(b, 5), fourth))

    fixed = let(let(let(clamped, left), high), reset)
    return F.when(status == "ok", fixed).otherwise(bounds), status


def rule_boundaries(text: Column | str) -> Column:
    """The default model: boundaries from the phrases that open the zones."""
    t = col(text)
    before = lambda phrase: F.nullif(F.instr(t, phrase), F.lit(0)) - 1
    n = F.length(t)
    z1 = F.coalesce(header_anchor(t), F.lit(0))
    z2 = F.coalesce(before("审理查明"), before("诉称"), z1)
    z3 = F.coalesce(before("本院认为"), z2)
    z4 = F.coalesce(verdict_anchor(t), z3)
    z5 = F.coalesce(before("案件受理费"), before("如不服本判决"), n)
    z6 = F.coalesce(before("审判长"), before("审判员"), n)
    return F.array(z1, z2, z3, z4, z5, z6).cast("array<int>")


def partition(text: Column | str, model: Callable[[Column], Column] = rule_boundaries, anchor: str = "auto", compat: bool = True) -> Column:
    """struct<text_length, anchor_status, anchor_end, boundaries, zones> of a text."""
    if anchor not in ("auto", "off"):
        raise ValueError(f"unsupported anchor policy: {anchor}")

    def facts(t: Column) -> Column:
        return F.struct(t.alias("t"), F.length(t).alias("n"), header_anchor(t).alias("z1"), verdict_anchor(t).alias("z4"), monotonic(model(t), F.length(t)).alias("raw"))

    def bound(f: Column) -> Column:
        b, status = anchored(f["raw"], f["z1"], f["z4"], f["n"], compat) if anchor == "auto" else (f["raw"], F.lit("off"))
        empty = f["n"] == 0
        return F.struct(f.alias("f"), F.when(empty, F.array().cast("array<int>")).otherwise(b).alias("b"), F.when(empty, "empty_or_unsplittable").otherwise(status).alias("s"))

    def record(r: Column) -> Column:
        t, n, b, empty = r["f"]["t"], r["f"]["n"], r["b"], r["f"]["n"] == 0
        edge = lambda i: F.lit(0) if i < 0 else n if i > 5 else F.get(b, F.lit(i))

        def zone(i: int) -> Column:
            start, end = F.when(empty, 0).otherwise(edge(i - 1)).cast("int"), F.when(empty, 0).otherwise(edge(i)).cast("int")
            return F.struct(start.alias("start"), end.alias("end"), F.substring(t, start + 1, F.greatest(F.lit(0), end - start)).alias("text")).alias(ZONES[i])

        ends = F.struct(F.when(~empty, r["f"]["z1"]).alias(ZONES[0]), F.when(~empty, r["f"]["z4"]).alias(ZONES[3]))
        return F.struct(n.alias("text_length"), r["s"].alias("anchor_status"), ends.alias("anchor_end"), b.alias("boundaries"), F.struct(*(zone(i) for i in range(7))).alias("zones"))

    return let(let(let(F.coalesce(col(text), F.lit("")), facts), bound), record)


#: Fields of a record that its partition keeps, and where its text may stand.
PASSED, TEXTS = ("sample_id", "case_no", "case_name"), ("text", "full_text")


def partition_records(df: DataFrame, model: Callable[[Column], Column] = rule_boundaries, anchor: str = "auto", compat: bool = True) -> DataFrame:
    """The partition of each record's text, after those of the passed-on fields that the records have. The first filled text counts."""
    have = [df[c] for c in TEXTS if c in df.columns]
    p = partition(filled(*have) if have else F.lit(""), model, anchor, compat)
    return df.select(*(c for c in PASSED if c in df.columns), p.alias("_p")).select(*(c for c in PASSED if c in df.columns), "_p.*")


def partition_text(spark: SparkSession, text: str | None, model: Callable[[Column], Column] = rule_boundaries, anchor: str = "auto", compat: bool = True) -> dict:
    """One text's partition as a dict."""
    row = spark.createDataFrame([(text,)], "text string").select(partition("text", model, anchor, compat).alias("p")).first()
    return row["p"].asDict(recursive=True)


def zone_text(top: Column | None, nested: Column | None, plain: Column | None = None) -> Column:
    """A zone's text where records keep it at top level (even empty), in zones.<name>.text, or in zones.<name>."""
    return F.coalesce(*(c for c in (top, nested, plain) if c is not None), F.lit(""))


def zone_text_filled(top: Column, nested: Column, question: Column, name: str) -> Column:
    """A zone's stripped text, from the first place where it isn't blank; the last place is JSON in ``question``."""
    from judgex.functions.pytext import strip

    return F.coalesce(*(F.nullif(strip(c), F.lit("")) for c in (top, nested, F.get_json_object(question, f"$.{name}"))), F.lit(""))


def encoded(sentence: Column, vocabulary: Column, unknown: int) -> Column:
    """Vocabulary ids of the first 80 visible characters; [unknown] where there are none. ``vocabulary`` is a map column."""
    chars = F.filter(F.split(sentence, ""), lambda c: ~c.rlike(f"\\A[{SPACE}]*\\z"))
    ids = F.transform(F.slice(chars, 1, MAX_CHARS), lambda c: F.coalesce(F.try_element_at(vocabulary, c), F.lit(unknown)))
    return F.when(F.size(ids) > 0, ids).otherwise(F.array(F.lit(unknown)))
