"""Loan amounts in Chinese text: numerals, units, scoring of candidates. All native expressions."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from judgex.functions.pytext import SPACE, any_of, blank, col, let, matches, strip

#: Units and their worth in yuan.
UNITS = {"元": 1, "万": 10_000, "万元": 10_000, "亿": 100_000_000, "亿元": 100_000_000}
#: Numerals with their values, and formal or traditional ones with the plain ones they stand for.
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
TENS = {"十": 10, "百": 100, "千": 1000}
FORMAL, PLAIN = "壹贰叁肆伍陆柒捌玖貳兩拾佰仟萬億圆", "一二三四五六七八九二两十百千万亿元"
#: Words that tell what a sentence is about, and the labels of results.
PAYMENT = ("判令", "应当", "支付", "给付", "偿还", "归还", "返还", "清偿", "判决如下")
PRINCIPAL = ("本金", "借款", "欠款", "借款本金", "应偿还")
NEGATIVE = ("诉讼费", "受理费", "保全", "撤诉", "驳回起诉", "移送", "利息", "违约金", "罚息")
WEAK = ("借款", "欠款", "本金", "金额", "标的", "冻结", "偿还", "归还", "支付", "给付")
TYPES, PLACES = ("交付金额", "涉案金额", "unknown", "payment", "loan"), ("Z4", "Z3", "none")
DELIVERED, INVOLVED = "交付金额", "涉案金额"

_ASCII = r"[0-9]+(?:\.[0-9]+)?"
NUMBER = r"\p{Nd}+(?:\.\p{Nd}+)?"
_UNIT = "(亿元|亿|万元|万|元)"
_CN = "[零〇一二两三四五六七八九十百千万亿壹贰叁肆伍陆柒捌玖拾佰仟萬億貳兩]+"
ARABIC_UNIT = f"(?:人民币)?[{SPACE}]*({_ASCII})[{SPACE}]*{_UNIT}"
CN_UNIT = f"(?:人民币)?[{SPACE}]*({_CN})[{SPACE}]*{_UNIT}"
KEYWORD = rf"(?:借款|欠款|本金|偿还|归还|返还|支付|给付|清偿)[^。；;，,\n]{{0,12}}?({_ASCII})"
_STOPS = "。；;\\n"
#: Private characters around notes in a text, and the one that stands for them where the text has them itself.
_MARKS, _OTHER = ("\ue000", "\ue001", "\ue002"), "\ue003"
_SCALE = "decimal(38,10)"


def _section(c: Column) -> Column:
    """Value of numerals below ten thousand; other characters don't count."""
    state = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("num"))
    digit = F.create_map(*(F.lit(x) for kv in DIGITS.items() for x in kv))
    ten = F.create_map(*(F.lit(x) for kv in TENS.items() for x in kv))

    def step(s: Column, ch: Column) -> Column:
        d, u = F.try_element_at(digit, ch).cast("long"), F.try_element_at(ten, ch).cast("long")
        one = F.when(s["num"] == 0, 1).otherwise(s["num"])
        return F.struct(
            F.when(u.isNotNull(), s["total"] + one * u).otherwise(s["total"]).alias("total"),
            F.when(d.isNotNull(), d).when(u.isNotNull(), F.lit(0).cast("long")).otherwise(s["num"]).alias("num"),
        )

    return F.aggregate(F.split(c, ""), state, step, lambda s: s["total"] + s["num"])


def numeral(c: Column | str) -> Column:
    """Integer value of a Chinese numeral; null where there is none."""
    worth = lambda part: F.when(part == "", F.lit(1).cast("long")).otherwise(_section(part))

    def below(rest: Column) -> Column:
        wan = F.split(rest, "万", 2)
        return F.when(F.contains(rest, F.lit("万")), worth(F.get(wan, F.lit(0))) * 10_000 + _section(F.get(wan, F.lit(1)))).otherwise(_section(rest))

    def by_yi(yi: Column) -> Column:
        above = F.aggregate(F.slice(yi, F.lit(1), F.size(yi) - 1), F.lit(0).cast("long"), lambda t, p: t + worth(p) * 100_000_000)
        return (above + let(F.element_at(yi, -1), below)).cast("decimal(38,0)")

    def of(s: Column) -> Column:
        has = s.rlike("[零〇一二两三四五六七八九十百千万亿]")
        return F.when(s.rlike(r"\A[0-9]+\z"), s.try_cast("decimal(38,0)")).when(has, let(F.split(s, "亿", -1), by_yi))

    return let(strip(F.regexp_replace(F.translate(strip(c), FORMAL, PLAIN), "[元整正]", "")), of)


def plain(d: Column) -> Column:
    """A decimal without trailing zeros."""
    return let(d.cast("string"), lambda s: F.when(F.contains(s, F.lit(".")), F.regexp_replace(s, r"\.?0+\z", "")).otherwise(s))


def yuan(value: Column, unit: Column) -> Column:
    """A number (digits or numerals) of units, in yuan; "" where it is none."""

    def of(v: Column, u: Column) -> Column:
        worth = F.element_at(F.create_map(*(F.lit(x) for x in itertools.chain(*UNITS.items()))), u).cast("decimal(9,0)")
        number = F.when(v.rlike(rf"\A{_ASCII}\z"), v.try_cast("decimal(28,10)")).otherwise(numeral(v).cast("decimal(28,0)"))
        return F.coalesce(plain((number.cast("decimal(28,10)") * worth).cast(_SCALE)), F.lit(""))

    # one struct: either may come from a Python function, which no lambda may hold
    return let(F.struct(F.replace(value, F.lit(","), F.lit("")).alias("v"), unit.alias("u")), lambda p: of(p["v"], p["u"]))


def normalize(raw: Column | str) -> Column:
    """The amount in a value that a model or a person wrote, as plain digits; "" where there is none."""

    def of(s: Column) -> Column:
        part = lambda p, g: F.regexp_extract(s, p, g)
        return (
            F.when(s.rlike(ARABIC_UNIT), yuan(part(ARABIC_UNIT, 1), part(ARABIC_UNIT, 2)))
            .when(s.rlike(CN_UNIT), yuan(part(CN_UNIT, 1), part(CN_UNIT, 2)))
            .when(s.rlike(rf"\A{_ASCII}\z"), s)
            .otherwise(part(NUMBER, 0))
        )

    return let(F.replace(strip(F.coalesce(col(raw).cast("string"), F.lit(""))), F.lit(","), F.lit("")), of)


def normalize_local(raw: Column | str) -> Column:
    """As ``normalize``, but with the units 万 and 亿 and ASCII digits only."""
    unit = f"({_ASCII})[{SPACE}]*(万|亿)"
    of = lambda s: F.when(s.rlike(unit), yuan(F.regexp_extract(s, unit, 1), F.regexp_extract(s, unit, 2))).otherwise(F.regexp_extract(s, _ASCII, 0))
    return let(F.replace(strip(F.coalesce(col(raw).cast("string"), F.lit(""))), F.lit(","), F.lit("")), of)


def amount_type(raw: Column | str) -> Column:
    return let(strip(F.coalesce(col(raw), F.lit(""))), lambda s: F.when(s == "payment", DELIVERED).when(s == "loan", INVOLVED).when(s.isin(*TYPES), s).otherwise("unknown"))


def source_zone(raw: Column | str) -> Column:
    return let(strip(F.coalesce(col(raw), F.lit(""))), lambda s: F.when(s.isin(*PLACES), s).otherwise("none"))


def filled_up(amount: Column, kind: Column, zone: Column) -> Column:
    """struct<target_amount, amount_type, source_zone> in which type and zone complete each other; the zone sees the completed type."""

    def of(r: Column) -> Column:
        a, kind, zone = r["target_amount"], r["amount_type"], r["source_zone"]
        has = a != ""
        kind2 = F.when(has & (kind == "unknown") & (zone == "Z4"), DELIVERED).when(has & (kind == "unknown") & (zone == "Z3"), INVOLVED).otherwise(kind)
        zone2 = F.when(has & (zone == "none") & (kind2 == DELIVERED), "Z4").when(has & (zone == "none") & (kind2 == INVOLVED), "Z3").otherwise(zone)
        return result(a, F.when(has, kind2).otherwise("unknown"), F.when(has, zone2).otherwise("none"))

    return let(result(amount, kind, zone), of)


def result(amount: Column, kind: Column, zone: Column) -> Column:
    return F.struct(amount.alias("target_amount"), kind.alias("amount_type"), zone.alias("source_zone"))


def _score(sentence: Column, zone: str) -> Column:
    return F.lit(1 if zone == "Z4" else 0) + F.when(any_of(sentence, PAYMENT), 5).otherwise(0) + F.when(any_of(sentence, PRINCIPAL), 3).otherwise(0) - F.when(any_of(sentence, NEGATIVE), 4).otherwise(0)


def candidates(text: Column, zone: str) -> Column:
    """array<struct<score, amount>> in order: numbers with units, numerals with units, numbers after key words.

    A match belongs to the sentence that its start is in. Matches are written down where they start, between marks; then
    the text is cut at the stops once, so the work grows with the text and not with the matches times the text.
    """
    begin, middle, end = _MARKS
    note = f"{begin}[^{end}]*{end}"

    def of(pattern: str, groups: str, amount: Callable[[Column, Column], Column], more: int) -> Column:
        noted = F.regexp_replace(F.translate(text, "".join(_MARKS), _OTHER * 3), pattern, f"{begin}{groups}{end}$0")
        sentences = F.filter(F.split(noted, f"[{_STOPS}]", -1), lambda s: F.contains(s, F.lit(begin)))
        part = lambda m, i: F.regexp_extract(m, f"{begin}([^{middle}]*){middle}([^{end}]*){end}", i)

        def rated(s: Column) -> Column:
            found = F.regexp_extract_all(s, F.lit(note), F.lit(0))
            score = let(F.regexp_replace(s, note, ""), lambda bare: _score(bare, zone) + more)
            return let(score, lambda n: F.transform(found, lambda m: F.struct(n.alias("score"), amount(part(m, 1), part(m, 2)).alias("amount"))))

        return F.filter(F.flatten(F.transform(sentences, rated)), lambda c: c["amount"] != "")

    united = f"$1{middle}$2"
    return F.concat(of(ARABIC_UNIT, united, yuan, 0), of(CN_UNIT, united, yuan, 0), of(KEYWORD, f"$1{middle}", lambda n, _: n, 1))


def weak_number(text: Column | str) -> Column:
    """The largest number from 5000 that has a weak key word within ten characters; "" without one."""
    t = col(text)

    def near(m: Column) -> Column:
        end = m["start"] + F.length(m["text"])
        left = F.greatest(F.lit(0), m["start"] - 10)
        return let(F.substring(t, left + 1, end + 10 - left), lambda around: any_of(around, WEAK))

    values = F.transform(F.filter(matches(t, NUMBER), near), lambda m: m["text"].try_cast("decimal(28,10)"))
    most = F.array_max(F.filter(values, lambda v: v >= 5000))
    return F.coalesce(plain(most), F.lit(""))


def best(text: Column | str, zone: str) -> Column:
    """The amount that a zone's text most likely decides; "" where none is good enough."""
    zero = F.lit(0).cast("decimal(28,10)")

    def of(t: Column) -> Column:
        ranked = F.transform(candidates(t, zone), lambda c, i: F.struct(c["score"], F.coalesce(c["amount"].try_cast("decimal(28,10)"), zero), -i, c["amount"].alias("amount")))
        low = lambda top: top["score"] < (1 if zone == "Z4" else 0)
        pick = lambda top: F.when(top.isNull(), "").when(low(top), F.lit("") if zone == "Z4" else weak_number(t)).otherwise(top["amount"])
        return F.when(blank(t), "").otherwise(let(F.array_max(ranked), pick))

    return let(F.coalesce(col(text), F.lit("")), of)


def heuristic(z4: Column | str, z3: Column | str) -> Column:
    """struct<target_amount, amount_type, source_zone> from the reasoning, else from the facts."""
    none = result(F.lit(""), F.lit("unknown"), F.lit("none"))
    facts = let(best(z3, "Z3"), lambda a: F.when(a != "", result(a, F.lit(INVOLVED), F.lit("Z3"))).otherwise(none))
    return let(best(z4, "Z4"), lambda a: F.when(a != "", result(a, F.lit(DELIVERED), F.lit("Z4"))).otherwise(facts))
