"""Queries over calls, row processors, guarded records and observed counters.

Models are stood in for by a transport that derives its replies, failures included, from the text it is sent; everything else is what a run
against a real endpoint does.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions import messages
from judgex.operators import calls, guard, observe, processors, resume
from judgex.plans.cases import CASES, FEES, duck, view
from judgex.plans.queries import query
from judgex.session import cut

_QUOTED = {"law": messages.LAW_SYSTEM, "amount": messages.AMOUNT_SYSTEM, "fee": messages.FEE_SYSTEM}


def stand_in(payload: str, _: str | None, sent: int) -> calls.Reply:
    """Replies as endpoints give them, by a number in the text: a fee in yuan, or else the text's length."""
    user = json.loads(payload)["messages"][-1]["content"]
    fee = re.search(r"受理费(\d+)元", user)
    n = int(fee[1]) if fee else len(user)
    content = f'```json\n{{"total_litigation_cost": {n}, "citations": [{{"law_name": "合同法", "article": "第{n}条"}}]}}\n```'
    match n % 11:
        case 0:
            return calls.Reply(400, "bad request")
        case 1 if sent <= n % 8:
            return calls.Reply(429, "slow down")
        case 2 if sent <= n % 6:
            return calls.Reply(503, "")
        case 3:
            content = "不是 JSON"
        case 4:
            return calls.Reply(200, '{"choices": []}')
        case 5:
            return calls.Reply(200, '{"error": "quota"}')
        case 6:
            raise calls.Unsent("timeout", "no reply")
        case 7:
            return calls.Reply(200, '{"error": "Rate limit reached"}')
    return calls.Reply(200, json.dumps({"choices": [{"message": {"content": content}}]}))


def _recovered(payload: str, key: str | None, _: int) -> calls.Reply:
    """The stand-in on a good day: every request is answered."""
    return calls.Reply(200, '{"choices": [{"message": {"content": "{\\"total_litigation_cost\\": -1}"}}]}')


def _sql_outcome(n: str) -> str:
    """Columns of a call's outcome, by its number."""
    return f"""
    CASE WHEN {n} % 11 IN (0, 3, 4, 5, 6, 7) OR ({n} % 11 = 1 AND {n} % 8 > 5) OR ({n} % 11 = 2 AND {n} % 6 > 3) THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN {n} % 11 = 0 THEN 'client' WHEN {n} % 11 = 1 AND {n} % 8 > 5 THEN 'rate_limit' WHEN {n} % 11 = 2 AND {n} % 6 > 3 THEN 'server' WHEN {n} % 11 = 3 THEN 'json' WHEN {n} % 11 = 4 THEN 'structure'
         WHEN {n} % 11 = 5 THEN 'api' WHEN {n} % 11 = 6 THEN 'timeout' WHEN {n} % 11 = 7 THEN 'rate_limit' END AS error_kind,
    CASE WHEN {n} % 11 = 1 THEN least({n} % 8, 5) WHEN {n} % 11 = 7 THEN 5 ELSE 0 END AS limited,
    CASE WHEN {n} % 11 = 2 THEN [0.0, 0.0, 2.0, 6.0, 6.0, 6.0][1 + {n} % 6] WHEN {n} % 11 = 6 THEN 6.0 ELSE 0.0 END AS waited"""


def _fee_rows(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, FEES)
    texts = F.when(F.col("passage").isNull(), F.array().cast("array<string>")).otherwise(F.array("passage"))
    data = F.struct(F.array(F.lit("某甲")).alias("plaintiffs"), F.array(F.lit("某乙")).alias("defendants"), texts.alias("cost_texts"))
    return f.select(F.col("_pos").alias("k"), "case_no", F.struct("case_no", F.col("_pos").alias("pos")).alias("meta"), data.alias("input_data"))


def _fees_done(spark: SparkSession, sf: str, transport: calls.Transport = stand_in):
    return lambda rows: processors.processed(rows, processors.fee_task("fee-model"), transport, ("sk-one-aaaa", "sk-two-aaaa"), clock=calls.QuickClock)


def _opened(df: DataFrame, field: str) -> DataFrame:
    got = lambda path, kind: F.try_variant_get("envelope", path, kind)
    return df.select(
        "k", "status", "error_kind", got("$.perf.attempts", "int").alias("attempts"), got("$.perf.rate_limit_retries", "int").alias("limited"), got("$.perf.latency", "double").alias("latency"),
        got("$.perf.key_tail", "string").alias("key_tail"), got("$.error_msg", "string").alias("error_msg"), got(f"$.{field}.total_litigation_cost", "int").alias("total"), got("$.status", "string").alias("said"),
    )


def _sql_rows(skip_message: str) -> str:
    """What ``_opened`` makes of rows (k, n, empty)."""
    return f"""
  SELECT k, CASE WHEN empty THEN 'skipped' ELSE status END AS status, CASE WHEN NOT empty THEN error_kind END AS error_kind, CASE WHEN NOT empty THEN CAST(limited + 1 AS INT) END AS attempts,
         CASE WHEN NOT empty THEN CAST(limited AS INT) END AS limited, CASE WHEN NOT empty THEN CAST(pow(2, limited + 1) - 2 + waited AS DOUBLE) END AS latency, CASE WHEN NOT empty THEN 'aaaa' END AS key_tail,
         CASE WHEN empty THEN '{skip_message}' WHEN error_kind = 'client' THEN 'HTTP 400 Error' WHEN error_kind = 'server' THEN 'HTTP 503 Error' WHEN error_kind = 'rate_limit' AND n % 11 = 1 THEN 'HTTP 429 Error'
              WHEN error_kind = 'rate_limit' THEN 'API Business Error: Rate limit reached' WHEN error_kind = 'api' THEN 'API Business Error: quota' WHEN error_kind = 'timeout' THEN 'Request Timed Out: no reply'
              WHEN error_kind = 'json' THEN 'JSON Parsing Failed (LLM output was not valid JSON)' WHEN error_kind = 'structure' THEN 'Invalid Response Structure (No choices found)' END AS error_msg,
         CASE WHEN NOT empty AND status = 'success' THEN CAST(n AS INT) END AS total, CASE WHEN empty THEN 'skipped' ELSE status END AS said
  FROM (SELECT k, n, empty, {_sql_outcome("n")} FROM numbered)"""


_FEE_NUMBERS = "SELECT _pos AS k, coalesce(case_no, '') AS case_no, fee AS n, passage IS NULL AS empty FROM fees"


@query("fee_rows_processed", duck(_sql_rows("No cost text found in input"), fees=FEES, numbered=_FEE_NUMBERS))
def fee_rows_processed(spark, sf):
    return _opened(_fees_done(spark, sf)(_fee_rows(spark, sf)), "extraction_result")


#: The citation model's user message is 25 characters longer than the text.
_LAW_EXTRA = len('【待抽取文本】\n"""\n' + '\n"""\n\n请输出 JSON。')
_LAW_NUMBERS = f"SELECT k, CASE WHEN k % 50 = 0 THEN 0 ELSE length(z4) + {_LAW_EXTRA} END AS n, k % 50 = 0 AS empty FROM cases"


@query("citation_rows_processed", duck(_sql_rows("empty_text"), numbered=_LAW_NUMBERS))
def citation_rows_processed(spark, sf):
    rows = view(spark, sf, CASES).select("k", F.when(F.col("k") % 50 != 0, F.col("z4")).alias("z4"))
    return _opened(processors.processed(rows, processors.citation_task("law-model", "z4"), stand_in, ("sk-aaaa",), clock=calls.QuickClock), "data")


@query("fee_rows_resumed", duck(f"""
  SELECT k, CASE WHEN empty THEN 'skipped' ELSE 'success' END AS status, CASE WHEN empty THEN NULL WHEN case_no = '' OR status = 'failed' OR k % 3 = 0 THEN -1 ELSE CAST(n AS INT) END AS total
  FROM (SELECT k, case_no, n, empty, {_sql_outcome("n")} FROM numbered)""", fees=FEES, numbered=_FEE_NUMBERS))
def fee_rows_resumed(spark, sf):
    """A run that saw two thirds of the rows and failed on some, and the next one, which takes the rest and what failed."""
    rows = _fee_rows(spark, sf)
    first = cut(_fees_done(spark, sf)(rows.filter("k % 3 != 0")), "fees-first-run")
    both = processors.resumed(rows, first, "case", _fees_done(spark, sf, _recovered))
    return both.select("k", "status", F.try_variant_get("envelope", "$.extraction_result.total_litigation_cost", "int").alias("total"))


_MEANS = ", ".join(f"avg(CASE WHEN status = '{s}' THEN latency END) AS mean_latency_{s}" for s in observe.STATUSES)


@query("observed_counters", duck(f"""
  SELECT count(*) AS rows, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
         avg(latency) AS mean_latency, max(latency) AS max_latency, {_MEANS}, CAST(sum(limited) AS BIGINT) AS waits FROM ({_sql_rows("")})""", fees=FEES, numbered=_FEE_NUMBERS))
def observed_counters(spark, sf):
    """The counters of a run, observed while its rows are written: nothing is asked or read twice."""
    done = _fees_done(spark, sf)(_fee_rows(spark, sf))
    perf = lambda name, kind: F.try_variant_get("envelope", f"$.perf.{name}", kind)
    exprs = observe.counters(latency=perf("latency", "double"), waits=F.sum(perf("rate_limit_retries", "long")))
    rows, seen = observe.counted(done, *exprs, name="fees")
    cut(rows, "fees-observed")
    kinds = ", ".join(f"{c} {'double' if 'latency' in c else 'long'}" for c in seen.row)
    return spark.createDataFrame([tuple(seen.row.values())], kinds)


_PAYLOADS = {
    "amount": ("z4, z3", messages.AMOUNT_TOKENS, """concat('【Z4】', chr(10), '\"\"\"', chr(10), z4, chr(10), '\"\"\"', chr(10), chr(10), '【Z3】', chr(10), '\"\"\"', chr(10), z3, chr(10), '\"\"\"')"""),
    "law": ("z4", messages.LAW_TOKENS, """concat('【待抽取文本】', chr(10), '\"\"\"', chr(10), z4, chr(10), '\"\"\"', chr(10), chr(10), '请输出 JSON。')"""),
}


def _payload_sql(name: str) -> str:
    _, tokens, user = _PAYLOADS[name]
    body = f"""json_extract_string(to_json({user}), '$')"""
    return f"""SELECT k, '{name}-model' AS model, 'system,user' AS roles, '{_QUOTED[name]}' AS system, {body} AS user, CAST({tokens} AS INT) AS max_tokens, 'false' AS stream, 'json_object' AS form FROM cases"""


def _taken_apart(df: DataFrame) -> DataFrame:
    at = lambda path, kind="string": F.try_variant_get(F.parse_json("p"), path, kind)
    return df.select(
        "k", at("$.model").alias("model"), F.concat_ws(",", at("$.messages[0].role"), at("$.messages[1].role")).alias("roles"), at("$.messages[0].content").alias("system"), at("$.messages[1].content").alias("user"),
        at("$.max_tokens", "int").alias("max_tokens"), at("$.stream").alias("stream"), at("$.response_format.type").alias("form"),
    )


@query("payload_amount", duck(_payload_sql("amount")))
def payload_amount(spark, sf):
    return _taken_apart(view(spark, sf, CASES).select("k", messages.amount_payload("amount-model", "z4", "z3").alias("p")))


@query("payload_law", duck(_payload_sql("law")))
def payload_law(spark, sf):
    return _taken_apart(view(spark, sf, CASES).select("k", messages.law_payload("law-model", "z4").alias("p")))


# --- guarded records --------------------------------------------------------------------------------------------------

_ODD = """
SELECT k, path AS _file, raw, CASE WHEN k % 12 = 5 THEN '  ' WHEN k % 12 = 6 THEN NULL ELSE z4 END AS text, replace(replace(replace(raw, '元', ''), ',', ''), '人民币', '') AS amount_text,
       concat(cast(2010 + k % 7 AS STRING), '-', CASE WHEN k % 15 < 10 THEN '0' ELSE '' END, cast(k % 15 AS STRING), '-', CASE WHEN k % 31 < 10 THEN '0' ELSE '' END, cast(k % 31 AS STRING)) AS day_text,
       concat('{"law": "', law, CASE WHEN k % 6 = 1 THEN '"' ELSE '"}' END) AS law_text
FROM cases
"""


@query("guarded_rows", duck("""
  SELECT k, amount, day, law, CAST((amount IS NULL)::INT + (day IS NULL)::INT + (law IS NULL)::INT AS INT) AS n_issues,
         array_to_string(list_filter([CASE WHEN amount IS NULL THEN 'amount:not a number:' || amount_text END, CASE WHEN day IS NULL THEN 'day:not a date like yyyy-MM-dd:' || day_text END, CASE WHEN law IS NULL THEN 'law:not JSON:' || law_text END], lambda x: x IS NOT NULL), ';') AS issues
  FROM (SELECT k, amount_text, day_text, law_text, CAST(TRY_CAST(amount_text AS DECIMAL(18,2)) AS DOUBLE) AS amount, CAST(try_strptime(day_text, '%Y-%m-%d') AS DATE) AS day, CASE WHEN json_valid(law_text) THEN json_extract_string(law_text, '$.law') END AS law FROM odd)""", odd=_ODD))
def guarded_rows(spark, sf):
    """Every record with its values and what was wrong with it, from both sides of the split: bad rows are all there."""
    odd = view(spark, sf, _ODD)
    rows = guard.guarded(odd, amount=guard.number(F.col("amount_text")), day=guard.date(F.col("day_text")), law=guard.json_of(F.col("law_text"), "law string"))
    good, bad = guard.settled(rows, "guarded-rows")
    both = good.withColumn("issues", F.array().cast(guard.ISSUES)).unionByName(bad)
    said = F.array_join(F.transform("issues", lambda i: F.concat_ws(":", i["step"], i["reason"], i["input"])), ";")
    return both.select("k", F.col("amount").cast("double").alias("amount"), "day", "law.law", F.size("issues").alias("n_issues"), said.alias("issues"))


_BAD = {"amount": ("not a number", "TRY_CAST(amount_text AS DECIMAL(18,2)) IS NULL"), "day": ("not a date like yyyy-MM-dd", "try_strptime(day_text, '%Y-%m-%d') IS NULL"), "law": ("not JSON", "NOT json_valid(law_text)")}


@query("quarantine_reasons", duck(" UNION ALL ".join(f"SELECT '{s}' AS step, '{r}' AS reason, count(*) AS records, count(*) AS issues FROM odd WHERE {w}" for s, (r, w) in _BAD.items()), odd=_ODD))
def quarantine_reasons(spark, sf):
    odd = view(spark, sf, _ODD)
    rows = guard.guarded(odd, amount=guard.number(F.col("amount_text")), day=guard.date(F.col("day_text")), law=guard.json_of(F.col("law_text"), "law string"))
    return guard.reasons(guard.settled(rows, "quarantine").quarantine)


def _predict(r: dict) -> dict:
    """A stand-in for a boundary predictor that fails on some texts."""
    text = (r["text"] or "").strip()
    if "双方" in text:
        raise ValueError("no boundary found")
    return {"n": 10 // (len(text) - 23) if text else 0, "ending": text[-2:]}  # texts of 23 characters divide by zero


@query("guarded_predictions", duck("""
  SELECT _file AS file, count(*) AS rows_seen, count(*) FILTER (empty) AS rows_empty, count(*) FILTER (NOT empty AND bad) AS rows_failed, count(*) FILTER (NOT empty AND NOT bad) AS rows_written
  FROM (SELECT _file, trim(coalesce(text, '')) = '' AS empty, coalesce(contains(text, '双方') OR length(trim(text)) = 23, false) AS bad FROM odd) GROUP BY 1""", odd=_ODD))
def guarded_predictions(spark, sf):
    """A predictor in Python over every record, guarded, with the counts that a run reports for each of its files."""
    rows = guard.guarded_map(view(spark, sf, _ODD).select("k", "_file", "text"), _predict, "n int, ending string", "predict")
    return guard.file_counts(rows, F.col("text")).withColumnRenamed("_file", "file")


# --- keys -------------------------------------------------------------------------------------------------------------

_KEYLESS = "SELECT path AS _file, k AS _pos, k, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN ' ' ELSE case_no END AS case_no, CASE WHEN k % 5 < 2 THEN NULL ELSE path END AS source_file FROM cases"
_WHOLE = "concat(coalesce(source_file, ''), '::', trim(coalesce(case_no, '')))"


@query("upsert_keyless", duck(f"""SELECT k FROM filed WHERE k % 3 = 0 UNION ALL SELECT k FROM filed WHERE k % 3 <> 0 AND {_WHOLE} = '::' UNION ALL
  SELECT k FROM (SELECT k, row_number() OVER (PARTITION BY {_WHOLE} ORDER BY list_filter(string_split(_file, '/'), lambda p: p <> ''), _pos) AS r FROM filed WHERE k % 3 <> 0 AND {_WHOLE} <> '::' AND {_WHOLE} NOT IN (SELECT {_WHOLE} FROM filed WHERE k % 3 = 0)) WHERE r = 1""", filed=_KEYLESS))
def upsert_keyless(spark, sf):
    """Rows whose key is empty can't be told apart: an upsert appends them all."""
    f = view(spark, sf, _KEYLESS)
    return resume.upsert(f.filter("k % 3 = 0"), f.filter("k % 3 != 0")).select("k")
