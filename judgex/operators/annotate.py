"""Annotation by language models behind one interface, with a native heuristic as default.

A model is a function from prompts to answers that runs on the executors. Calls happen once a row in Arrow batches, last in the
plan, after all filters; ``concurrency`` bounds the tasks that call at once. Keys come from the environment.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judgex.functions import amounts, llmjson
from judgex.functions.pytext import blank
from judgex.operators import calls
from judgex.operators.calls import FACTOR, FIRST_WAIT, LONGEST_WAIT, MOST_RETRIES
from judgex.session import ship

Model = Callable[[str, str | None], str]


def rate_limited(message: Column | str) -> Column:
    m = F.lower(F.coalesce(message if isinstance(message, Column) else F.col(message), F.lit("")))
    return F.contains(m, F.lit("429")) | F.contains(m, F.lit("too many requests")) | F.contains(m, F.lit("rate limit"))


def wait(retry: Column | str) -> Column:
    """Seconds to wait before a retry (0 is the first)."""
    r = retry if isinstance(retry, Column) else F.col(retry)
    return F.least(F.lit(LONGEST_WAIT), (FIRST_WAIT * F.pow(F.lit(float(FACTOR)), r)).cast("int"))


def key_number(keys: int, *by: Column | str) -> Column:
    """Which of several keys a row uses: spread by the first 32 bits of an md5, the same on every run."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", *by)), 1, 8), 16, 10).cast("long"), F.lit(keys)).cast("int")


def called(df: DataFrame, prompt: Column, model: Model, keys: tuple[str, ...] = (), concurrency: int | None = None, in_flight: int = 1) -> DataFrame:
    """``df`` with answer, error, attempts and latency of a model's call for each row.

    A task keeps ``in_flight`` calls open, which the model must allow for; ``concurrency`` bounds the tasks. For endpoints
    whose errors should be told apart see ``calls.requested``.
    """
    ship(df.sparkSession)
    rows = df.withColumn("_prompt", prompt).withColumn("_key", key_number(len(keys), "_prompt") if keys else F.lit(-1))
    rows = rows.repartition(concurrency) if concurrency else rows
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in (("answer", T.StringType()), ("error", T.StringType()), ("attempts", T.IntegerType()), ("latency", T.DoubleType())))])

    def ask(item: tuple[str, str | None]) -> tuple[str | None, str | None, int, float]:
        began, tries = time.monotonic(), 0
        while True:
            tries += 1
            try:
                return model(*item), None, tries, round(time.monotonic() - began, 2)
            except Exception as e:  # a model's failure is a result of the row
                if tries > MOST_RETRIES or not calls.rate_limited(str(e)):
                    return None, str(e), tries, round(time.monotonic() - began, 2)
                time.sleep(calls.rate_wait(tries - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = [(p, keys[k] if k >= 0 else None) for p, k in zip(b.column("_prompt").to_pylist(), b.column("_key").to_pylist())]
            cols = list(zip(*calls.in_order(items, ask, in_flight))) or [(), (), (), ()]
            made = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 2)] + made, names=schema.names)

    return rows.mapInArrow(run, schema)


def heuristic_amounts(df: DataFrame, z4: Column | str = "z4", z3: Column | str = "z3") -> DataFrame:
    """``df`` with amount (a struct), status and error_msg, without a model: all native."""
    found = amounts.heuristic(z4, z3)
    empty = blank(z4) & blank(z3)
    df = df.withColumn("amount", F.when(empty, amounts.result(F.lit(""), F.lit("unknown"), F.lit("none"))).otherwise(found))
    status = F.when(empty, "skipped").when(F.col("amount.target_amount") != "", "success").otherwise("failed")
    return df.withColumn("status", status).withColumn("error_msg", F.when(empty, "empty_z3_z4").when(F.col("status") == "success", "empty_api_keys_used_fallback").otherwise("empty_api_keys"))


def answered_amounts(df: DataFrame, z4: Column | str = "z4", z3: Column | str = "z3", api: bool = True) -> DataFrame:
    """Rows with an answer or an error as amounts: the model's, normalised; the heuristic's where it has none."""
    raw = F.from_json(F.when(F.col("error").isNull(), llmjson.first_object("answer")), llmjson.AMOUNT)
    norm = amounts.normalize if api else amounts.normalize_local
    df = df.withColumn("_raw", raw)
    df = df.withColumn("_model", amounts.filled_up(norm("_raw.target_amount"), amounts.amount_type("_raw.amount_type"), amounts.source_zone("_raw.source_zone")))
    empty = blank(z4) & blank(z3)
    use_model = F.col("error").isNull() & (F.col("_model.target_amount") != "")
    df = df.withColumn("_plain", F.when(~F.coalesce(use_model, F.lit(False)), amounts.heuristic(z4, z3)))
    df = df.withColumn("amount", F.when(empty, amounts.result(F.lit(""), F.lit("unknown"), F.lit("none"))).when(use_model, F.col("_model")).otherwise(F.col("_plain")))
    good = F.col("error").isNull() | (F.col("_plain.target_amount") != "")
    return df.withColumn("status", F.when(empty, "skipped").when(good, "success").otherwise("failed")).drop("_raw", "_model", "_plain")


def http_model(url: str, name: str, timeout: float = 120.0, key_variable: str = "JUDGEX_API_KEY") -> Model:
    """A model behind a chat endpoint with the common JSON interface; opt-in, the key comes from the environment."""

    def call(prompt: str, key: str | None) -> str:
        import json
        import urllib.error
        import urllib.request

        body = json.dumps({"model": name, "messages": [{"role": "user", "content": prompt}], "stream": False, "temperature": 0.0}).encode()
        secret = key or os.environ.get(key_variable, "")
        req = urllib.request.Request(url, body, {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {secret}"} if secret else {}))
        try:
            with urllib.request.urlopen(req, timeout=timeout) as r:
                got = json.load(r)
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"HTTP {e.code}") from e
        return got["choices"][0]["message"]["content"] if "choices" in got else got["message"]["content"]

    return call
