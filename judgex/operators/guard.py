"""A guard for every record: what fails goes to a quarantine with its reason; it neither ends the job nor is lost.

Columns are guarded by ``try_*`` expressions, which are null where they fail: a ``Step`` fails where its value is null though its input is
not. Functions in Python are guarded record by record inside Arrow batches. Either way a row gets ``issues``, an array of (step, reason, input), empty where all went well.

``settled`` writes the guarded rows once, dealt by outcome, and gives both sides back from that table, so the
work behind them is done once and the two sides always add up.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judgex.session import cut, ship

ISSUES = "array<struct<step:string,reason:string,input:string>>"


class Step(NamedTuple):
    """A guarded column: its value, null on failure; the input that must be null for a null value to be right; why it fails."""

    value: Column
    input: Column
    reason: Column | str


def number(c: Column, kind: str = "decimal(18,2)") -> Step:
    return Step(c.try_cast(kind), c, "not a number")


def date(c: Column, form: str = "yyyy-MM-dd") -> Step:
    return Step(F.try_to_date(c, form), c, f"not a date like {form}")


def json_of(c: Column, schema: str) -> Step:
    """A JSON text as ``schema``; text that isn't JSON fails, missing fields are null."""
    return Step(F.when(F.try_parse_json(c).isNotNull(), F.from_json(c, schema)), c, "not JSON")


def needed(c: Column) -> Step:
    """A value that must be there."""
    return Step(c, F.lit("null"), "missing")


def guarded(df: DataFrame, **steps: Step) -> DataFrame:
    """``df`` with the steps' values, named by them, and ``issues``, to which earlier ones are kept."""
    old = F.col("issues") if "issues" in df.columns else F.array().cast(ISSUES)
    each = []
    for name, s in steps.items():
        reason = F.lit(s.reason) if isinstance(s.reason, str) else s.reason
        issue = F.struct(F.lit(name).alias("step"), reason.alias("reason"), s.input.cast("string").alias("input"))
        each.append(F.when(s.value.isNull() & s.input.isNotNull(), issue))
    found = F.concat(old, F.array_compact(F.array(*each)).cast(ISSUES)) if each else old
    keep = [c for c in df.columns if c not in steps and c != "issues"]
    return df.select(*keep, *(s.value.alias(n) for n, s in steps.items()), found.alias("issues"))


def guarded_map(df: DataFrame, f: Callable[[dict], dict], schema: str, step: str) -> DataFrame:
    """``df`` with the fields of ``schema`` that ``f`` makes of each row, null where it raises, and ``issues``."""
    ship(df.sparkSession)
    made = T.StructType.fromDDL(schema)
    df = df if "issues" in df.columns else df.withColumn("issues", F.array().cast(ISSUES))
    keep = [x for x in df.schema.fields if x.name != "issues"]
    if clash := {x.name for x in keep} & set(made.names):
        raise ValueError(f"columns are there already: {sorted(clash)}")
    out = T.StructType([*keep, *made.fields, df.schema["issues"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(out)
        for b in batches:
            rows, issues = [], []
            for r in b.to_pylist():
                old = r.pop("issues") or []
                try:
                    got = f(r)
                    row = pa.array([{n: got.get(n) for n in made.names}], pa.struct([types.field(n) for n in made.names]))[0].as_py()  # a value of another type is a failure, too
                    issues.append(old)
                except Exception as e:  # the record's own
                    row = dict.fromkeys(made.names)
                    issues.append([*old, {"step": step, "reason": f"{type(e).__name__}: {e}", "input": json.dumps(r, ensure_ascii=False, default=str)}])
                rows.append(row)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(x.name)) for x in keep), *(pa.array([r[n] for r in rows], types.field(n).type) for n in made.names), pa.array(issues, types.field("issues").type)],
                names=out.names,
            )

    return df.mapInArrow(run, out)


class Settled(NamedTuple):
    good: DataFrame
    quarantine: DataFrame


def split(df: DataFrame) -> Settled:
    """Good rows without ``issues``; the others with them."""
    return Settled(df.filter(F.size("issues") == 0).drop("issues"), df.filter(F.size("issues") > 0))


def settled(df: DataFrame, name: str = "guarded") -> Settled:
    """As ``split``, from rows that are made once and written."""
    return split(cut(df, name))


def reasons(quarantine: DataFrame) -> DataFrame:
    """Rows (step, reason, records, issues): how many records and issues each reason has."""
    each = quarantine.select(F.monotonically_increasing_id().alias("_row"), F.explode("issues").alias("i")).select("_row", "i.step", "i.reason")
    by_row = each.groupBy("_row", "step", "reason").agg(F.count(F.lit(1)).alias("n"))
    return by_row.groupBy("step", "reason").agg(F.count(F.lit(1)).alias("records"), F.sum("n").alias("issues"))


def file_counts(df: DataFrame, text: Column, by: str = "_file") -> DataFrame:
    """Rows (file, rows_seen, rows_empty, rows_failed, rows_written) of guarded rows: empty texts aren't tried, failed ones not written."""
    from judgex.functions.pytext import blank

    empty, failed = blank(text), F.size("issues") > 0
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.count_if(empty).alias("rows_empty"), F.count_if(~empty & failed).alias("rows_failed"), F.count_if(~empty & ~failed).alias("rows_written")
    )
