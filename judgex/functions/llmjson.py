"""Reading JSON out of what language models write."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from judgex.functions import amounts
from judgex.functions.citations import CITATION
from judgex.functions.pytext import col, let, strip
from judgex.session import ship

AMOUNT = "struct<target_amount:string,amount_type:string,source_zone:string>"


def unfenced(c: Column | str) -> Column:
    """Stripped text without a Markdown fence: its first line if that opens one, and a closing one."""

    def of(s: Column) -> Column:
        body = F.when(F.contains(s, F.lit("\n")), F.regexp_replace(s, r"\A[^\n]*\n", "")).otherwise(s)
        return F.when(s.startswith("```"), strip(F.regexp_replace(body, r"```\z", ""))).otherwise(s)

    return let(strip(F.coalesce(col(c), F.lit(""))), of)


def strict(c: Column | str, schema: str) -> Column:
    """struct<status, data>: the whole unfenced text as JSON of a schema, or status error."""

    def of(p: Column) -> Column:
        return F.struct(F.when(p["ok"], "success").otherwise("error").alias("status"), F.when(p["ok"], F.from_json(p["s"], schema)).alias("data"))

    return let(let(unfenced(c), lambda s: F.struct(s.alias("s"), F.try_parse_json(s).isNotNull().alias("ok"))), of)


def citations(c: Column | str) -> Column:
    """array<struct<law_name, article, source_span, confidence>> from an object's ``citations`` or a bare array.

    The block runs from the first bracket to the last of its kind; what doesn't parse gives an empty array, as does an object without citations.
    """
    s = unfenced(c)
    obj, arr = F.instr(s, "{"), F.instr(s, "[")
    array_first = (arr > 0) & F.regexp_like(s, F.lit(r"(?s)\[.*\]")) & ((obj == 0) | (arr < obj))
    empty = F.array().cast(f"array<{CITATION}>")
    from_array = F.from_json(F.when(F.try_parse_json(F.regexp_extract(s, r"(?s)\[.*\]", 0)).isNotNull(), F.regexp_extract(s, r"(?s)\[.*\]", 0)), f"array<{CITATION}>")
    block = F.regexp_extract(s, r"(?s)\{.*\}", 0)
    from_object = F.from_json(F.when(F.try_parse_json(block).isNotNull(), block), f"citations array<{CITATION}>")["citations"]
    return F.coalesce(F.when(array_first, from_array).otherwise(from_object), empty)


def coerced_citations(c: Column | str) -> Column:
    """The citations in a JSON text that holds one object, an array (other elements dropped) or a string (none)."""
    v = F.try_parse_json(col(c))
    kind = F.schema_of_variant(v)
    one = F.array(F.from_json(col(c), CITATION))
    many = F.filter(F.from_json(col(c), "array<string>"), lambda x: x.startswith("{"))
    return F.when(kind.startswith("OBJECT"), one).when(kind.startswith("ARRAY"), F.transform(many, lambda x: F.from_json(x, CITATION))).otherwise(F.array().cast(f"array<{CITATION}>"))


def _blocks(text: str) -> Iterator[str]:
    """The outermost pairs of braces, braces in strings included; a closing brace that closes nothing counts for nothing."""
    at = [m.start() for m in re.finditer(r"[{}]", text)]
    depths = accumulate((1 if text[i] == "{" else -1 for i in at), lambda depth, step: max(depth + step, 0), initial=0)
    opened = None
    for (before, after), i in zip(pairwise(depths), at):
        if before == 0 and after == 1:
            opened = i
        elif before == 1 and after == 0:
            yield text[opened : i + 1]


def _object_in(text: str | None) -> str | None:
    """A text that is a JSON object, or the first outermost pair of braces that is one."""
    for candidate in chain([text], _blocks(text)) if text else ():
        try:
            if isinstance(json.loads(candidate), dict):
                return candidate
        except ValueError:
            pass
    return None


def first_object(c: Column | str) -> Column:
    """The first JSON object in a text, as text. Only texts that aren't one object already go to Python, by Arrow: balanced braces are not regular.

    Name the result once (``let``), as every mention of it is computed by itself.
    """
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def find(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else _object_in(x) or "")

    # null goes to Python, and comes back, for a text that is one object; "" comes back where there is none
    whole = lambda s: F.coalesce(s.startswith("{") & F.try_parse_json(s).isNotNull(), F.lit(False))
    other = let(unfenced(c), lambda s: F.when(~whole(s), s))
    return F.nullif(F.coalesce(find(other), unfenced(c)), F.lit(""))


def amount(c: Column | str) -> Column:
    """struct<target_amount, amount_type, source_zone> from a model's answer, normalised and completed."""
    made = lambda d: amounts.filled_up(amounts.normalize_local(d["target_amount"]), amounts.amount_type(d["amount_type"]), amounts.source_zone(d["source_zone"]))
    return let(F.from_json(first_object(c), AMOUNT), made)
