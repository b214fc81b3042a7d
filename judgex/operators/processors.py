"""Row processors: skip, call, parse, package. Each step is a column over the call's outcome; the result is one VARIANT envelope a row.

An envelope has the fields that its status calls for, in JSON's sense: a skipped row's lacks ``perf``, a successful one's lacks
``error_msg``, and so on. ``status`` is kept beside it for filters. Rows that failed or were never done can be processed again by
``resumed``; an earlier success stays.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgex.functions import llmjson, messages
from judgex.functions.pytext import col
from judgex.operators import calls
from judgex.operators.resume import remaining, resume_key

SUCCESS, FAILED, SKIPPED = "success", "failed", "skipped"


class Task(NamedTuple):
    """What a processor asks, and what its envelopes hold besides.

    ``empty`` marks rows to skip; ``field`` names the result; ``nothing`` are the results, as JSON, of rows skipped and failed.
    """

    payload: Column
    empty: Column
    skip_message: str
    field: str
    nothing: tuple[str, str]
    meta: Column | None = None


def fee_task(model: str) -> Task:
    """Over rows of merged fees: meta, and input_data with plaintiffs, defendants and cost_texts."""
    d = lambda name: F.coalesce(F.col(f"input_data.{name}"), F.array().cast("array<string>"))
    payload = messages.fee_payload(model, d("cost_texts"), d("plaintiffs"), d("defendants"))
    # fixed values: the message of skipped rows, and what their result is
    return Task(payload, F.size(d("cost_texts")) == 0, "No cost text found in input", "extraction_result", ("null", "{}"), F.col("meta"))


def citation_task(model: str, text: Column | str) -> Task:
    """Over rows with a text; only null and "" are empty."""
    t = F.coalesce(col(text), F.lit(""))
    # fixed values: as above
    return Task(messages.law_payload(model, t), t == "", "empty_text", "data", ('{"citations": []}', '{"citations": []}'))


def _perf(call: Column) -> Column:
    return F.struct(*(call[c].alias(c) for c in ("latency", "key_tail", "attempts", "rate_limit_retries")))


def packaged(df: DataFrame, task: Task) -> DataFrame:
    """``df``, whose rows have a ``call``, with status, error_kind and envelope instead of it."""
    call, data = F.col("call"), F.try_parse_json(llmjson.unfenced("call.content"))
    df = df.withColumn("_data", data)
    broken = call["error"].isNull() & F.col("_data").isNull()
    status = F.when(task.empty, SKIPPED).when(call["error"].isNull() & ~broken, SUCCESS).otherwise(FAILED)
    df = df.withColumn("status", status).withColumn("error_kind", F.when(F.col("status") == FAILED, F.when(broken, "json").otherwise(call["error"]["kind"])))
    message = F.when(broken, F.lit(calls.SAID["json"])).otherwise(call["error"]["message"])
    raw = F.when(broken, call["content"]).otherwise(call["error"]["raw"])
    meta = [task.meta.alias("meta")] if task.meta is not None else []
    state, skipped, failed = F.col("status").alias("status"), *(F.parse_json(F.lit(x)).alias(task.field) for x in task.nothing)
    shapes = {
        SKIPPED: [*meta, state, F.lit(task.skip_message).alias("error_msg"), skipped],
        SUCCESS: [*meta, F.col("_data").alias(task.field), state, _perf(call).alias("perf")],
        FAILED: [*meta, failed, state, _perf(call).alias("perf"), message.alias("error_msg"), raw.alias("raw_response")],
    }
    envelope = F.coalesce(*(F.when(F.col("status") == s, F.to_variant_object(F.struct(*fields))) for s, fields in shapes.items()))
    return df.withColumn("envelope", envelope).drop("_data", "call")


def processed(df: DataFrame, task: Task, transport: calls.Transport, keys: tuple[str, ...] = (), in_flight: int = 8, tasks: int | None = None, clock: Callable[[], calls.Clock] = calls.Clock) -> DataFrame:
    """``df`` with status, error_kind and envelope of each row; empty rows are skipped without a call."""
    asked = calls.requested(df, F.when(~task.empty, task.payload), transport, keys, in_flight, tasks, clock=clock)
    return packaged(asked, task)


def resumed(df: DataFrame, earlier: DataFrame, kind: str, process: Callable[[DataFrame], DataFrame], only_success: bool = True) -> DataFrame:
    """Results of all rows: of an earlier run what is done, else of ``process``.

    Rows are told apart by the key of ``kind``; ``only_success`` processes what failed again, otherwise any earlier result counts. Rows
    without a key can't be recognised and are always processed, so their earlier results go. ``earlier`` must be a written table.
    """
    done = earlier.filter("status = 'success'") if only_success else earlier
    return done.filter(resume_key(kind) != "").unionByName(process(remaining(df, earlier, kind, only_success)), allowMissingColumns=True)


def json_of(envelope: Column | str = "envelope") -> Column:
    """An envelope as JSON text; its fields come in the order of their names, as VARIANT keeps them."""
    return F.to_json(col(envelope))
