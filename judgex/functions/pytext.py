"""Text functions with the semantics of Python's str, as native column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from judgex.session import ship

#: White space as Python's str.strip and \s see it, as the inside of a character class (Java's own \s is ASCII only).
SPACE = r"\t-\r\x1c-\x20\x85\xa0" + "".join(f"\\u{i:04x}" for i in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
#: The same characters themselves, for trimming.
BLANKS = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: JSON's short escapes: control character, escape.
JSON_SHORT = (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"))
_RARE = [i for i in range(0x20) if chr(i) not in "\n\r\t"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is evaluated once and named once, however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def squeeze(c: Column | str) -> Column:
    """Without any white space."""
    return F.regexp_replace(col(c), f"[{SPACE}]+", "")


def blank(c: Column | str) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(strip(c) == "", F.lit(True))


def filled(*cs: Column | str) -> Column:
    """The first value that is neither null nor empty, as in ``a or b``; "" if there is none."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in cs), F.lit(""))


def key(c: Column | str) -> Column:
    """A business key: text, stripped; "" for null."""
    return strip(F.coalesce(col(c).cast("string"), F.lit("")))


def json_string(c: Column | str) -> Column:
    """A JSON string literal as json.dumps(ensure_ascii=False) writes it; null for null."""

    def escaped(s: Column) -> Column:
        rare, short = s, dict(JSON_SHORT)
        for i in _RARE:
            rare = F.replace(rare, F.lit(chr(i)), F.lit(short.get(chr(i), f"\\u{i:04x}")))
        return F.concat(F.lit('"'), F.when(s.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), rare).otherwise(s), F.lit('"'))

    s = F.replace(F.replace(col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, esc in JSON_SHORT[:3]:
        s = F.replace(s, F.lit(raw), F.lit(esc))
    return let(s, escaped)


def json_object(**fields: Column | str) -> Column:
    """A JSON object of string fields, in order, with json.dumps' separators."""
    parts: list[Column] = []
    for i, (name, c) in enumerate(fields.items()):
        parts += [F.lit(f'{", " if i else ""}"{name}": '), F.coalesce(json_string(c), F.lit("null"))]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def list_repr(c: Column | str) -> Column:
    """An array of strings as Python's repr of a list of str writes it."""

    def one(x: Column) -> Column:
        s = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        for raw, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\xa0", "\\xa0"), ("\u3000", "\\u3000")):
            s = F.replace(s, F.lit(raw), F.lit(esc))
        double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
        quoted = F.when(double, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'")))
        return F.coalesce(quoted, F.lit("None"))

    return F.concat(F.lit("["), F.array_join(F.transform(col(c), one), ", "), F.lit("]"))


def matches(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start, text>>; starts are 0-based code points (Spark's regexp_instr counts UTF-16)."""

    def of(p: Column) -> Column:
        n = F.size(p["found"])
        long = F.zip_with(F.slice(p["gaps"], F.lit(1), n), p["found"], lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("own")))
        state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        step = lambda s, x: F.struct((s["at"] + x["gap"] + x["own"]).alias("at"), F.concat(s["starts"], F.array(s["at"] + x["gap"])).alias("starts"))
        return F.zip_with(F.aggregate(long, state, step, lambda s: s["starts"]), p["found"], lambda at, m: F.struct(at.alias("start"), m.alias("text")))

    return let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")), of)


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text contains one of some literal words."""
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w))
    return hit


def flat(c: Column | str) -> Column:
    """Line ends as a literal backslash and n."""
    s = F.replace(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.replace(s, F.lit("\n"), F.lit("\\n"))


def nfkc(c: Column | str) -> Column:
    """Unicode NFKC. Spark has no expression for it; batches of bounded size go to Python by Arrow, ASCII ones unchanged."""
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))

    return normal(col(c))
