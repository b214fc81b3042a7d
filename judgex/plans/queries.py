"""Registry of the core queries over the driver's tables, and the same as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions import amounts, citations, llmjson, paths, prompts, zones
from judgex.functions.pytext import flat, json_object, key, list_repr, nfkc, strip
from judgex.operators import annotate, fees, resume, sft
from judgex.plans.cases import CASES, CITED, FEES, LABELS, ROLES, TEXTS, duck, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def _cases(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, CASES)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- training samples -------------------------------------------------------------------------------------------------

_KEY = "trim(coalesce(case_no, ''))"
_SI = prompts.AMOUNT_INSTRUCTION
_GATED = f"""
, t AS (SELECT trim(case_no) AS c, count(*) AS n, arg_min(z4, (_file, _pos)) AS z4, arg_min(z3, (_file, _pos)) AS z3 FROM texts WHERE {_KEY} <> '' GROUP BY 1),
l AS (
  SELECT *, {_KEY} AS c, row_number() OVER (PARTITION BY {_KEY} ORDER BY _file, _pos) AS nth, regexp_full_match(trim(target_amount), '[0-9]+([.][0-9]+)?') AS good FROM labels
), g AS (
  SELECT l._pos, l.c, l.nth, coalesce(t.n, 0) AS n, CASE WHEN good THEN trim(target_amount) ELSE '' END AS a,
         CASE WHEN good AND amount_type IN ('交付金额', '涉案金额') THEN amount_type ELSE 'unknown' END AS k, CASE WHEN good AND source_zone IN ('Z3', 'Z4') THEN source_zone ELSE 'none' END AS z, t.z4, t.z3
  FROM l LEFT JOIN t ON l.c = t.c
), q AS (
  SELECT *, concat('{{"Z4_Reasoning": "', z4, '", "Z3_Fact": "', z3, '"}}') AS question, concat('{{"target_amount": "', a, '", "amount_type": "', k, '", "source_zone": "', z, '"}}') AS answer FROM g
), o AS (
  SELECT *, CASE WHEN c = '' THEN 'empty_case_no' WHEN nth > 1 THEN 'duplicate' WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'ambiguous'
    WHEN k = 'unknown' OR z = 'none' THEN 'invalid_or_filtered_amount' WHEN 7 + {len(_SI)} + length(question) + length(answer) > 12000 THEN 'overlength' ELSE 'valid' END AS outcome FROM q
)
"""


def _sft(select: str) -> str:
    return duck("", labels=LABELS, texts=TEXTS).rstrip() + _GATED + select


def _gated(spark: SparkSession, sf: str) -> DataFrame:
    return sft.gated(view(spark, sf, LABELS), view(spark, sf, TEXTS))


@query("sft_amount_funnel", _sft("""SELECT count(*) AS total, count(*) FILTER (outcome = 'valid') AS valid, count(*) FILTER (outcome = 'missing') AS missing, count(*) FILTER (outcome = 'ambiguous') AS ambiguous,
  count(*) FILTER (outcome IN ('empty_case_no', 'invalid_or_filtered_amount')) AS invalid, count(*) FILTER (outcome = 'overlength') AS overlength, count(*) FILTER (outcome = 'duplicate') AS duplicate,
  count(DISTINCT nullif(c, '')) AS unique_case_no FROM o"""))
def sft_amount_funnel(spark, sf):
    return sft.funnel(_gated(spark, sf))


@query("sft_amount_rejects", _sft("SELECT _pos AS pos, c AS case_no, CAST(n AS BIGINT) AS candidate_count, outcome FROM o WHERE outcome <> 'valid'"))
def sft_amount_rejects(spark, sf):
    return _gated(spark, sf).filter("outcome != 'valid'").select(F.col("_pos").alias("pos"), "case_no", "candidate_count", "outcome")


@query("sft_amount_samples", _sft(f"SELECT c AS case_no, '{_SI}' AS instruction, question, answer, k AS amount_type, z AS source_zone FROM o WHERE outcome = 'valid'"))
def sft_amount_samples(spark, sf):
    return sft.samples(_gated(spark, sf))


@query("sft_overlength", _sft(f"SELECT c AS case_no, {len(_SI) + 3} AS instruction_len, length(question) + 2 AS question_len, length(answer) + 2 AS answer_len FROM o WHERE outcome = 'overlength'"))
def sft_overlength(spark, sf):
    n = lambda c: F.length(f"sample.{c}").alias(f"{c}_len")
    return _gated(spark, sf).filter("outcome = 'overlength'").select("case_no", n("instruction"), n("question"), n("answer"))


@query("label_text_lookup", duck(f"SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN coalesce(n, 0) = 0 THEN 'missing' WHEN n = 1 THEN 'match' ELSE 'ambiguous' END AS outcome FROM labels l LEFT JOIN (SELECT trim(case_no) AS c, count(*) AS n FROM texts WHERE {_KEY} <> '' GROUP BY 1) t ON trim(l.case_no) = t.c WHERE trim(coalesce(l.case_no, '')) <> '') GROUP BY 1", labels=LABELS, texts=TEXTS))
def label_text_lookup(spark, sf):
    t = view(spark, sf, TEXTS).select(key("case_no").alias("c")).filter("c != ''").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    rows = view(spark, sf, LABELS).select(key("case_no").alias("c")).filter("c != ''").join(t, "c", "left")
    return rows.groupBy(F.when(F.col("n").isNull(), "missing").when(F.col("n") == 1, "match").otherwise("ambiguous").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


# --- zones ------------------------------------------------------------------------------------------------------------

_Z1 = "CASE WHEN strpos(reverse(left(t, 100)), '号') > 0 THEN length(left(t, 100)) - strpos(reverse(left(t, 100)), '号') + 1 END"
_VERDICT = r"(判\s*决\s*如\s*下|如\s*下\s*判\s*决)\s*[:：]?"
_Z4 = f"CASE WHEN regexp_extract(t, '{_VERDICT}') <> '' THEN strpos(t, regexp_extract(t, '{_VERDICT}')) - 1 + length(regexp_extract(t, '{_VERDICT}')) END"
_BOUNDS = r"""list_sort(list_distinct(list_filter(list_concat([0], list_transform(range(1, len(p) + 1), lambda i: CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) AS INT)), [z1, z4]), lambda x: x IS NOT NULL)))"""


@query("zone_anchors", duck(f"SELECT k, z1, z4, CASE WHEN z1 IS NULL OR z4 IS NULL THEN 'missing_anchor' WHEN z1 < z4 THEN 'ok' ELSE 'invalid_anchor_order' END AS status FROM (SELECT k, {_Z1} AS z1, {_Z4} AS z4 FROM (SELECT k, CASE WHEN k % 7 = 0 THEN z3 ELSE full_text END AS t FROM cases))"))
def zone_anchors(spark, sf):
    c = _cases(spark, sf).select("k", F.expr("CASE WHEN k % 7 = 0 THEN z3 ELSE full_text END").alias("t"))
    c = c.select("k", zones.header_anchor("t").alias("z1"), zones.verdict_anchor("t").alias("z4"))
    return c.withColumn("status", F.when(F.col("z1").isNull() | F.col("z4").isNull(), "missing_anchor").when(F.expr("z1 < z4"), "ok").otherwise("invalid_anchor_order"))


@query("sentence_boundaries", duck(f"SELECT k, array_to_string({_BOUNDS}, ',') AS bounds FROM (SELECT k, {_Z1} AS z1, {_Z4} AS z4, regexp_extract_all(t, '[^。！？!?；;：:、\\n]*[。！？!?；;：:、\\n]+|[^。！？!?；;：:、\\n]+') AS p FROM (SELECT k, full_text AS t FROM cases))"))
def sentence_boundaries(spark, sf):
    return _cases(spark, sf).select("k", F.array_join(zones.boundaries("full_text").cast("array<string>"), ",").alias("bounds"))


@query("sentence_slices", r"""WITH s AS (SELECT doc_id, regexp_extract_all(text, '[^。！？!?；;：:、\n]*[。！？!?；;：:、\n]+|[^。！？!?；;：:、\n]+') AS p FROM documents)
  SELECT doc_id, CAST(len(p) AS INT) AS n_slices, CAST(coalesce(list_max(list_transform(p, lambda x: length(x))), 0) AS INT) AS longest, CAST(CASE WHEN len(p) <= 240 THEN len(p) ELSE least(240, (len(p) - 1) // (len(p) // 240) + 1) END AS INT) AS n_sampled FROM s""")
def sentence_slices(spark, sf):
    s = _table(spark, sf, "documents").select("doc_id", zones.slices(zones.boundaries("text")).alias("s"))
    return s.select("doc_id", F.size("s").alias("n_slices"), F.coalesce(F.array_max(F.transform("s", lambda x: x["end"] - x["start"])), F.lit(0)).alias("longest"), F.size(zones.downsample("s")).alias("n_sampled"))


@query("zone_partition", duck(f"""SELECT k, length(t) AS text_length, 'ok' AS anchor_status, substr(t, 1, z1) AS header, substr(t, b2 + 1, b3 - b2) AS fact, substr(t, b3 + 1, z4 - b3) AS reasoning, substr(t, z5 + 1, z6 - z5) AS footer
  FROM (SELECT k, t, {_Z1} AS z1, {_Z4} AS z4, strpos(t, '审理查明') - 1 AS b2, strpos(t, '本院认为') - 1 AS b3,
    CASE WHEN strpos(t, '案件受理费') > 0 THEN strpos(t, '案件受理费') - 1 END AS z5, strpos(t, '审判员') - 1 AS z6 FROM (SELECT k, full_text AS t FROM cases))"""))
def zone_partition(spark, sf):
    p = _cases(spark, sf).select("k", zones.partition("full_text").alias("p"))
    return p.select("k", "p.text_length", "p.anchor_status", F.col("p.zones.Z1_Header.text").alias("header"), F.col("p.zones.Z3_Fact.text").alias("fact"), F.col("p.zones.Z4_Reasoning.text").alias("reasoning"), F.col("p.zones.Z6_Footer.text").alias("footer"))


@query("zone_accessor", duck("SELECT k, coalesce(top, nested, '') AS loose, coalesce(nullif(trim(top), ''), nullif(trim(nested), ''), nullif(trim(json_extract_string(question, '$.Z4_Reasoning')), ''), '') AS filled FROM (SELECT k, CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN '' ELSE z4 END AS top, CASE WHEN k % 2 = 0 THEN NULL ELSE concat(' ', z3) END AS nested, concat('{\"Z4_Reasoning\": \"', z4, '\"}') AS question FROM cases)"))
def zone_accessor(spark, sf):
    c = _cases(spark, sf).selectExpr("k", "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN '' ELSE z4 END AS top", "CASE WHEN k % 2 = 0 THEN NULL ELSE concat(' ', z3) END AS nested", "z4")
    c = c.withColumn("question", json_object(Z4_Reasoning="z4"))
    return c.select("k", zones.zone_text(F.col("top"), F.col("nested")).alias("loose"), zones.zone_text_filled(F.col("top"), F.col("nested"), F.col("question"), "Z4_Reasoning").alias("filled"))


# --- amounts ----------------------------------------------------------------------------------------------------------

_CN_CASE = "WHEN r = '叁万元' THEN '30000' WHEN r = '二十万元' THEN '200000' WHEN r = '一百二十三万元' THEN '1230000'"
_UNIT = "CASE regexp_extract(r, '[0-9]+([.][0-9]+)?(亿元|亿|万元|万|元)', 2) WHEN '元' THEN 1 WHEN '万' THEN 10000 WHEN '万元' THEN 10000 ELSE 100000000 END"
_PLAIN = "regexp_replace(regexp_replace(CAST({} AS VARCHAR), '([.][0-9]*?)0+$', '\\1'), '[.]$', '')"
_NUM = "CAST(regexp_extract(r, '([0-9]+([.][0-9]+)?)(亿元|亿|万元|万|元)', 1) AS DECIMAL(18,4))"


@query("amount_normalize", duck(f"SELECT k, CASE WHEN regexp_matches(r, '[0-9]+([.][0-9]+)?(亿元|亿|万元|万|元)') THEN {_PLAIN.format(f'CAST({_NUM} * {_UNIT} AS DECIMAL(28,4))')} {_CN_CASE} ELSE regexp_extract(r, '[0-9]+([.][0-9]+)?') END AS amount FROM (SELECT k, replace(raw, ',', '') AS r FROM cases)"))
def amount_normalize(spark, sf):
    return _cases(spark, sf).select("k", amounts.normalize("raw").alias("amount"))


_LOCAL = "CASE WHEN regexp_extract(r, '[0-9]+([.][0-9]+)?(万|亿)', 2) = '万' THEN 10000 ELSE 100000000 END"


@query("amount_normalize_local", duck(f"SELECT k, CASE WHEN regexp_matches(r, '[0-9]+([.][0-9]+)?(万|亿)') THEN {_PLAIN.format(f'''CAST(CAST(regexp_extract(r, '([0-9]+([.][0-9]+)?)(万|亿)', 1) AS DECIMAL(18,4)) * {_LOCAL} AS DECIMAL(28,4))''')} ELSE regexp_extract(r, '[0-9]+([.][0-9]+)?') END AS amount FROM (SELECT k, replace(raw, ',', '') AS r FROM cases)"))
def amount_normalize_local(spark, sf):
    return _cases(spark, sf).select("k", amounts.normalize_local("raw").alias("amount"))


def _numeral_sql(n: str) -> str:
    d = lambda x: f"substr('零一二三四五六七八九', CAST({x} AS INT) + 1, 1)"
    h, t, o = f"{n} // 100 % 10", f"{n} // 10 % 10", f"{n} % 10"
    hundreds = f"CASE WHEN {h} > 0 THEN concat({d(h)}, '百') WHEN {n} % 100 > 0 THEN '零' ELSE '' END"
    tens = f"CASE WHEN {t} > 0 THEN concat({d(t)}, '十') WHEN {h} > 0 AND {o} > 0 THEN '零' ELSE '' END"
    return f"concat({d(f'{n} // 1000')}, '千', {hundreds}, {tens}, CASE WHEN {o} = 0 THEN '' ELSE {d(o)} END)"


@query("cn_numerals_all", "SELECT c_custkey AS k, c_custkey * 7 % 9000 + 1000 AS small, (c_custkey * 7 % 9000 + 1000) * 10000 + c_custkey * 3 % 9000 + 1000 AS large FROM customer")
def cn_numerals_all(spark, sf):
    c = _table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_custkey * 7 % 9000 + 1000 AS a", "c_custkey * 3 % 9000 + 1000 AS b")
    sql = lambda n: F.expr(_numeral_sql(n).replace("//", "div"))
    return c.select("k", amounts.numeral(sql("a")).cast("long").alias("small"), amounts.numeral(F.concat(sql("a"), F.lit("万"), sql("b"))).cast("long").alias("large"))


@query("amount_crossfill", duck("SELECT _pos AS pos, a AS target_amount, CASE WHEN a = '' THEN 'unknown' ELSE k2 END AS amount_type, CASE WHEN a = '' THEN 'none' WHEN z = 'none' AND k2 = '交付金额' THEN 'Z4' WHEN z = 'none' AND k2 = '涉案金额' THEN 'Z3' ELSE z END AS source_zone FROM (SELECT *, CASE WHEN k = 'unknown' AND z = 'Z4' THEN '交付金额' WHEN k = 'unknown' AND z = 'Z3' THEN '涉案金额' ELSE k END AS k2 FROM (SELECT _pos, regexp_extract(target_amount, '[0-9]+([.][0-9]+)?') AS a, CASE amount_type WHEN 'payment' THEN '交付金额' ELSE amount_type END AS k, source_zone AS z FROM labels))", labels=LABELS))
def amount_crossfill(spark, sf):
    r = amounts.filled_up(amounts.normalize("target_amount"), amounts.amount_type("amount_type"), amounts.source_zone("source_zone"))
    return view(spark, sf, LABELS).select(F.col("_pos").alias("pos"), r.alias("r")).select("pos", "r.*")


@query("amount_heuristic")
def amount_heuristic(spark, sf):
    return _cases(spark, sf).select("k", amounts.heuristic("z4", "z3").alias("r")).select("k", "r.*")


@query("amount_candidates")
def amount_candidates(spark, sf):
    return _cases(spark, sf).select("k", F.posexplode(amounts.candidates(F.col("z4"), "Z4")).alias("i", "c")).select("k", "i", "c.*")


# --- dedup, resume, limits --------------------------------------------------------------------------------------------

_FILED = "SELECT path AS _file, k AS _pos, case_no, path AS source_file, cast(k % 3 AS STRING) AS sample_id, CASE WHEN k % 4 = 1 THEN 'failed' ELSE 'success' END AS status, k FROM cases"
_PARTS = "list_filter(string_split(_file, '/'), lambda p: p <> '')"


@query("first_wins_dedup", duck(f"SELECT k FROM (SELECT k, {_KEY} AS c, row_number() OVER (PARTITION BY {_KEY} ORDER BY {_PARTS}, _pos) AS r FROM filed) WHERE c = '' OR r = 1", filed=_FILED))
def first_wins_dedup(spark, sf):
    return resume.first_wins(view(spark, sf, _FILED)).select("k")


@query("last_wins_map", duck("SELECT case_no, arg_max(k, (" + _PARTS + ", _pos)) AS k FROM filed WHERE case_no IS NOT NULL GROUP BY 1", filed=_FILED))
def last_wins_map(spark, sf):
    return resume.last_wins(view(spark, sf, _FILED).filter("case_no is not null"), ["case_no"], "k")


def _resume_oracle(by: str, done: str) -> str:
    return duck(f"SELECT k FROM filed WHERE {by} NOT IN (SELECT {by} FROM filed WHERE {done} AND {by} <> '')", filed=_FILED)


@query("resume_any", _resume_oracle(_KEY, "k % 5 = 2"))
def resume_any(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.remaining(f, f.filter("k % 5 = 2")).select("k")


@query("resume_success_only", _resume_oracle(_KEY, "k % 5 = 2 AND status = 'success'"))
def resume_success_only(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.remaining(f, f.filter("k % 5 = 2"), only_success=True).select("k")


_FC = f"concat(trim(source_file), '::', {_KEY})"


@query("resume_file_case", _resume_oracle(_FC, "k % 5 = 2"))
def resume_file_case(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.remaining(f, f.filter("k % 5 = 2"), "file_case").select("k")


@query("resume_file_case_sample", _resume_oracle(f"concat({_FC}, '::', sample_id)", "k % 5 = 2"))
def resume_file_case_sample(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.remaining(f, f.filter("k % 5 = 2"), "file_case_sample").select("k")


@query("completed_keys", duck(f"SELECT DISTINCT {_KEY} AS case_no FROM filed WHERE (k % 5 = 2 OR k % 7 = 3) AND {_KEY} <> ''", filed=_FILED))
def completed_keys(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.completed(f.filter("k % 5 = 2"), f.filter("k % 7 = 3"))


@query("upsert_by_key", duck(f"SELECT k FROM filed WHERE k % 3 = 0 UNION ALL SELECT k FROM (SELECT k, row_number() OVER (PARTITION BY {_FC} ORDER BY {_PARTS}, _pos) AS r FROM filed WHERE k % 3 <> 0 AND {_FC} NOT IN (SELECT {_FC} FROM filed WHERE k % 3 = 0)) WHERE r = 1", filed=_FILED))
def upsert_by_key(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.upsert(f.filter("k % 3 = 0"), f.filter("k % 3 != 0")).select("k")


@query("target_total_limit", duck(f"SELECT k FROM filed ORDER BY {_PARTS}, _pos LIMIT 140", filed=_FILED))
def target_total_limit(spark, sf):
    return resume.take_up_to(view(spark, sf, _FILED), 200, 60).select("k")


@query("rows_per_file_limit", duck("SELECT k FROM (SELECT k, row_number() OVER (PARTITION BY _file ORDER BY _pos) - 1 AS p FROM filed) WHERE p < 5", filed=_FILED))
def rows_per_file_limit(spark, sf):
    from pyspark.sql import Window

    f = view(spark, sf, _FILED)
    return resume.rows_per_file(f.withColumn("_pos", F.row_number().over(Window.partitionBy("_file").orderBy("_pos")) - 1), 5).select("k")


@query("first_files_limit", duck(f"SELECT k FROM filed WHERE _file IN (SELECT _file FROM (SELECT DISTINCT _file FROM filed) ORDER BY {_PARTS} LIMIT 7)", filed=_FILED))
def first_files_limit(spark, sf):
    return resume.first_files(view(spark, sf, _FILED), 7).select("k")


@query("until_n_valid", duck(f"SELECT k FROM (SELECT k, coalesce(sum(CASE WHEN status = 'success' AND k % 9 < 4 THEN 1 ELSE 0 END) OVER (ORDER BY {_PARTS}, _pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM filed) WHERE seen < 300", filed=_FILED))
def until_n_valid(spark, sf):
    return resume.until_valid(view(spark, sf, _FILED), F.expr("status = 'success' and k % 9 < 4"), 300).select("k")


@query("seeded_sample", duck("SELECT k FROM cases ORDER BY md5(concat('42:', cast(k AS STRING))), k LIMIT 50"))
def seeded_sample(spark, sf):
    return resume.seeded_sample(view(spark, sf, _FILED), 50, 42, "k").select("k")


@query("salvaged_keys", "SELECT o_orderkey AS k, unnest([concat('A', CAST(o_orderkey AS VARCHAR)), concat('B', CAST(o_custkey AS VARCHAR))]) AS case_no FROM orders")
def salvaged_keys(spark, sf):
    o = _table(spark, sf, "orders").selectExpr("o_orderkey AS k", """concat('[{"case_no": "A', o_orderkey, '", "x": 1}, {"case_no" : "B', o_custkey, '", "ta') AS t""")
    return o.select("k", F.explode(resume.salvaged_keys("t")).alias("case_no"))


@query("status_counters", duck("SELECT status, count(*) AS n, count(DISTINCT k % 97) AS groups FROM labels GROUP BY 1".replace("k % 97", "_pos % 97"), labels=LABELS))
def status_counters(spark, sf):
    return view(spark, sf, LABELS).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.expr("_pos % 97")).alias("groups"))


@query("remaining_count", duck(f"SELECT count(*) AS n FROM filed WHERE {_KEY} NOT IN (SELECT {_KEY} FROM filed WHERE k % 5 = 2 AND {_KEY} <> '')", filed=_FILED))
def remaining_count(spark, sf):
    f = view(spark, sf, _FILED)
    return resume.remaining(f, f.filter("k % 5 = 2")).agg(F.count(F.lit(1)).alias("n"))


# --- citations --------------------------------------------------------------------------------------------------------


def _with_citations(spark: SparkSession, sf: str) -> DataFrame:
    c = view(spark, sf, CITED).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "law_name", "article", "source_span"))).alias("c"))
    own = F.transform("c", lambda x: F.struct(x["law_name"].alias("law_name"), x["article"].alias("article"), x["source_span"].alias("source_span"), F.lit(0.9).alias("confidence")))
    cases = _cases(spark, sf).select("k", F.col("path").alias("source_file"), "case_no", F.col("z4").alias("Z4_Reasoning"))
    return cases.join(c.select("k", own.alias("citations")), "k", "left")


_PRON = "('同法', '本法', '该法', '本条例', '该条例', '本规定', '该规定', '')"
_RESOLVED = f"""
, n AS (SELECT k, i, trim(law_name) AS law, trim(article) AS article, source_span, CASE WHEN trim(law_name) IN {_PRON} THEN NULL ELSE trim(law_name) END AS named FROM cited),
seed AS (SELECT k, arg_max(named, f) AS s FROM (SELECT k, named, min(i) AS f FROM n WHERE named IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT n.k, i, article, source_span, CASE WHEN n.named IS NULL THEN coalesce(last_value(named IGNORE NULLS) OVER (PARTITION BY n.k ORDER BY i ROWS UNBOUNDED PRECEDING), seed.s) ELSE law END AS law, seed.s AS s FROM n LEFT JOIN seed ON n.k = seed.k)
"""


def _cite(select: str) -> str:
    return duck("", cited=CITED).rstrip() + _RESOLVED + select


@query("pronoun_resolve", _cite("SELECT k, string_agg(law, '|' ORDER BY i) AS laws FROM r WHERE s IS NOT NULL GROUP BY k"))
def pronoun_resolve(spark, sf):
    r = _with_citations(spark, sf).select("k", citations.resolved("citations").alias("r")).filter("size(r.resolved) > 0")
    return r.select("k", F.array_join(F.transform("r.resolved", lambda c: strip(c["law_name"])), "|").alias("laws"))


@query("pronoun_ambiguous", _cite("SELECT k, count(*) AS n FROM r WHERE s IS NULL GROUP BY k"))
def pronoun_ambiguous(spark, sf):
    r = _with_citations(spark, sf).select("k", citations.resolved("citations").alias("r"))
    return r.select("k", F.size("r.ambiguous").cast("long").alias("n")).filter("n > 0")


_ALIGN = r"""SELECT r.k, i FROM r JOIN cases c ON r.k = c.k WHERE s IS NOT NULL AND (
  (source_span <> '' AND strpos(z4, source_span) > 0) OR (article <> '' AND r.law <> ''
   AND (strpos(z4, r.law) > 0 OR (r.law LIKE '最高人民法院%' AND strpos(z4, ltrim(replace(r.law, '最高人民法院', ''), '关于')) > 0))
   AND (strpos(z4, article) > 0 OR (article LIKE '第%' AND strpos(z4, substr(article, 2)) > 0))))"""


@query("citation_align", _cite(f"SELECT k, count(*) AS n FROM ({_ALIGN}) GROUP BY k"))
def citation_align(spark, sf):
    r = sft.law_samples(_with_citations(spark, sf).withColumn("source_file", F.col("k").cast("string")), normal=False)
    return r.select(F.col("source_file").cast("long").alias("k"), F.size("aligned").cast("long").alias("n")).filter("n > 0")


@query("citation_clean", _cite("SELECT k, string_agg(concat(law, article), '|' ORDER BY f) AS pairs FROM (SELECT k, law, article, min(i) AS f FROM r WHERE s IS NOT NULL AND law <> '' AND article <> '' GROUP BY 1, 2, 3) GROUP BY k"))
def citation_clean(spark, sf):
    r = _with_citations(spark, sf).select("k", citations.cleaned(citations.resolved("citations")["resolved"]).alias("p")).filter("size(p) > 0")
    return r.select("k", F.array_join(F.transform("p", lambda p: F.concat(p["law_name"], p["article"])), "|").alias("pairs"))


_LAWS = {0: None, 1: [("合同法", "第九条")], 2: [("担保法", "第十八条|第二十一条")]}


@query("expected_articles", duck("""SELECT k, law, articles FROM (
  SELECT k, '合同法' AS law, concat('第六十条|', regexp_extract(z4, '第[0-9]+条')) AS articles FROM cases WHERE k % 4 = 0 AND k % 5 = 4
  UNION ALL SELECT k, '民诉法', '第64条' FROM cases WHERE k % 4 = 0 AND k % 5 = 4
  UNION ALL SELECT k, '合同法', '第九条' FROM cases WHERE k % 4 = 1 AND k % 5 = 4
  UNION ALL SELECT k, '担保法', '第十八条|第二十一条' FROM cases WHERE k % 4 = 2 AND k % 5 = 4)"""))
def expected_articles(spark, sf):
    e = _cases(spark, sf).select("k", F.explode(citations.expected("z4")).alias("e"))
    return e.select("k", "e.law", F.array_join("e.articles", "|").alias("articles"))


@query("completeness_issues", duck("""SELECT c.k, '担保法' AS law, CAST(count(DISTINCT article) AS INT) AS n_cited FROM cases c LEFT JOIN (SELECT * FROM cited WHERE law_name = '担保法' AND article <> '') x ON c.k = x.k
  WHERE c.k % 4 = 2 AND c.k % 5 = 4 GROUP BY 1 HAVING count(DISTINCT article) < 2
  UNION ALL SELECT c.k, '合同法', CAST(count(DISTINCT article) AS INT) FROM cases c LEFT JOIN (SELECT * FROM cited WHERE law_name = '合同法' AND article <> '') x ON c.k = x.k
  WHERE c.k % 4 = 0 AND c.k % 5 = 4 GROUP BY 1 HAVING count(DISTINCT article) < 2""", cited=CITED))
def completeness_issues(spark, sf):
    r = _with_citations(spark, sf).select("k", F.explode(citations.issues("Z4_Reasoning", "citations")).alias("x"))
    return r.select("k", "x.law", F.size("x.articles_in_citations").alias("n_cited"))


@query("law_sft_samples", _cite(f"""SELECT r.k, concat('答：[', string_agg(concat('{{"law_name": "', r.law, '", "article": "', article, '"}}'), ', ' ORDER BY f), ']') AS answer, concat('问：', any_value(z4)) AS question
  FROM (SELECT k, law, article, min(i) AS f FROM r WHERE s IS NOT NULL AND law <> '' AND article <> '' GROUP BY 1, 2, 3) r JOIN cases c ON r.k = c.k GROUP BY r.k"""))
def law_sft_samples(spark, sf):
    r = sft.law_samples(_with_citations(spark, sf).withColumn("source_file", F.col("k").cast("string")), normal=False).filter("outcome = 'valid'")
    return r.select(F.col("source_file").cast("long").alias("k"), "sample.answer", "sample.question")


@query("nfkc_normalize")
def nfkc_normalize(spark, sf):
    return _cases(spark, sf).select("k", citations.normalized(F.concat(F.lit("１２（ＡＢ） 〈"), F.col("law"), F.lit("〉　"))).alias("normal"), nfkc("law").alias("nfkc"))


@query("nfkc_texts", "SELECT doc_id, nfc_normalize(replace(text, 'é', concat('e', chr(769)))) AS text FROM documents")
def nfkc_texts(spark, sf):
    """Whole texts with accents taken apart and full-width digits, put together again."""
    apart = F.replace(F.translate("text", "0123456789", "０１２３４５６７８９"), F.lit("é"), F.lit("e\u0301"))
    return _table(spark, sf, "documents").select("doc_id", nfkc(apart).alias("text"))


# --- fees -------------------------------------------------------------------------------------------------------------


def _roles(spark: SparkSession, sf: str) -> DataFrame:
    r = view(spark, sf, ROLES)
    return r.select("_file", "_pos", F.struct("case_no").alias("meta"), F.struct(F.array("plaintiff").alias("plaintiff"), F.array("defendant").alias("defendant")).alias("annotation"), "status")


def _fees(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, FEES)
    passages = F.when(F.col("passage").isNull(), F.array().cast("array<string>")).otherwise(F.array("passage", F.lit("公告费\n20元。 ")))
    return f.select("_file", "_pos", F.struct("case_no").alias("meta"), F.struct(passages.alias("legal_cost_sentences")).alias("annotation"), "status")


_ROLE = "SELECT _file, case_no, arg_max(plaintiff, _pos) AS p, arg_max(defendant, _pos) AS d FROM roles WHERE status = 'success' GROUP BY 1, 2"


@query("role_fee_join", duck(f"SELECT f._pos AS pos, f.case_no, p AS plaintiff, d AS defendant, passage FROM fees f JOIN ({_ROLE}) r ON f._file = r._file AND f.case_no = r.case_no WHERE f.status = 'success' AND passage IS NOT NULL", roles=ROLES, fees=FEES))
def role_fee_join(spark, sf):
    f = _fees(spark, sf).withColumn("meta", F.struct("meta.case_no", "_pos"))
    m = fees.merged(_roles(spark, sf), f)
    return m.select(F.col("meta._pos").alias("pos"), "meta.case_no", F.col("input_data.plaintiffs")[0].alias("plaintiff"), F.col("input_data.defendants")[0].alias("defendant"), F.col("input_data.cost_texts")[0].alias("passage"))


_RESULT = """concat('{"total_litigation_cost": ', cast(fee AS STRING), '.0}')"""
_FINALS = f"SELECT replace(_file, 'result_', 'result_final_') AS _file, _pos, case_no, CASE WHEN _pos % 17 = 0 THEN '[]' WHEN _pos % 19 = 0 THEN NULL ELSE {_RESULT} END AS result_json, fee, CASE WHEN _pos % 23 = 4 THEN 'error' ELSE 'success' END AS status FROM fees"


def _finals(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, f"SELECT * FROM ({_FINALS.replace('FROM fees', f'FROM ({FEES}) fees')})")
    payer = F.struct(F.lit("某").alias("payer_name"), F.expr("CASE WHEN _pos % 3 = 0 THEN 'plaintiff' ELSE 'defendant' END").alias("payer_role"), F.col("fee").cast("double").alias("total_burden_amount"), F.expr("CASE WHEN _pos % 4 = 0 THEN 'joint' ELSE 'sole' END").alias("liability_type"))
    return f.select("_file", "_pos", F.struct("case_no").alias("meta"), "result_json", F.struct(F.array(payer).alias("burden_distribution")).alias("extraction_result"), "status")


@query("fee_training_rows", duck(f"""SELECT x.case_no, concat('问：【原告名单】：["', p, '"]\\n【被告名单】：[''', d, ''']\\n【费用段落】：', t, '\\n公告费20元。') AS question, concat('答：', result_json) AS answer
  FROM finals x JOIN ({_ROLE}) r ON replace(x._file, 'result_final_', 'result_') = r._file AND x.case_no = r.case_no
  JOIN (SELECT _file, case_no, arg_max(passage, _pos) AS t FROM fees WHERE status = 'success' GROUP BY 1, 2) f ON r._file = f._file AND x.case_no = f.case_no WHERE x.status = 'success' AND result_json LIKE '{{%' AND t IS NOT NULL""", roles=ROLES, fees=FEES, finals=_FINALS))
def fee_training_rows(spark, sf):
    return fees.training_rows(_finals(spark, sf), _roles(spark, sf), _fees(spark, sf)).filter("fits").select("case_no", "sample.question", "sample.answer")


@query("burden_rollup", duck("SELECT CASE WHEN _pos % 3 = 0 THEN 'plaintiff' ELSE 'defendant' END AS payer_role, CASE WHEN _pos % 4 = 0 THEN 'joint' ELSE 'sole' END AS liability_type, count(DISTINCT case_no) AS cases, count(*) AS payers, CAST(sum(CAST(fee AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM finals WHERE status = 'success' AND coalesce(case_no, '') <> '' GROUP BY 1, 2", fees=FEES, finals=_FINALS))
def burden_rollup(spark, sf):
    return fees.burdens(_finals(spark, sf))


# --- JSON of models, prompts, paths -----------------------------------------------------------------------------------

_ANSWER = """CASE k % 5 WHEN 0 THEN concat('```json', chr(10), body, chr(10), '```') WHEN 1 THEN concat('  ', body, ' ') WHEN 2 THEN concat('答案：', body, ' 完') WHEN 3 THEN concat('```', body) ELSE '没有' END"""
_ANSWERS = f"""SELECT k, {_ANSWER} AS answer, body FROM (SELECT k, concat('{{"target_amount": "', raw, '", "amount_type": "payment", "source_zone": "Z4"}}') AS body FROM cases) a"""


@query("fence_strip", duck("SELECT k, CASE k % 5 WHEN 0 THEN body WHEN 1 THEN body WHEN 2 THEN concat('答案：', body, ' 完') WHEN 3 THEN concat('```', body) ELSE '没有' END AS text FROM answers", answers=_ANSWERS))
def fence_strip(spark, sf):
    return view(spark, sf, _ANSWERS).select("k", llmjson.unfenced("answer").alias("text"))


@query("parse_strict_json", duck("SELECT k, CASE WHEN k % 5 < 2 THEN 'success' ELSE 'error' END AS status, CASE WHEN k % 5 < 2 THEN json_extract_string(body, '$.target_amount') END AS target_amount FROM answers", answers=_ANSWERS))
def parse_strict_json(spark, sf):
    return view(spark, sf, _ANSWERS).select("k", llmjson.strict("answer", llmjson.AMOUNT).alias("r")).select("k", "r.status", "r.data.target_amount")


_LOCAL = """CASE WHEN num = '' THEN '' WHEN unit = '万' THEN CAST(CAST(CAST(num AS DECIMAL(18,4)) * 10000 AS BIGINT) AS VARCHAR) WHEN unit = '亿' THEN CAST(CAST(CAST(num AS DECIMAL(18,4)) * 100000000 AS BIGINT) AS VARCHAR) ELSE num END"""


@query("parse_amount_json", duck(f"""SELECT k, t AS target_amount, CASE WHEN t <> '' THEN '交付金额' ELSE 'unknown' END AS amount_type, CASE WHEN t <> '' THEN 'Z4' ELSE 'none' END AS source_zone FROM (
  SELECT k, {_LOCAL} AS t FROM (SELECT k, regexp_extract(r, '[0-9]+([.][0-9]+)?') AS num, regexp_extract(r, '[0-9]([万亿])', 1) AS unit FROM (
    SELECT k, CASE WHEN obj <> '' THEN replace(json_extract_string(obj, '$.target_amount'), ',', '') ELSE '' END AS r FROM (SELECT k, regexp_extract(answer, '[{{][^}}]*[}}]') AS obj FROM answers))))""", answers=_ANSWERS))
def parse_amount_json(spark, sf):
    return view(spark, sf, _ANSWERS).select("k", llmjson.amount("answer").alias("r")).select("k", "r.*")


_CANS = """SELECT k, CASE k % 4 WHEN 0 THEN concat('[', c, ',', c, ']') WHEN 1 THEN concat('{"citations": [', c, ']}') WHEN 2 THEN concat('说明 {"citations": [', c, ', ', c, ', ', c, ']} 完') ELSE '{"citations": [' END AS answer
  FROM (SELECT k, concat('{"law_name": "合同法", "article": "第', cast(k AS STRING), '条"}') AS c FROM cases) a"""


@query("parse_citations_json", duck("SELECT k, CAST(CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 0 END AS INT) AS n, CASE WHEN k % 4 < 3 THEN concat('第', CAST(k AS VARCHAR), '条') END AS article FROM cases"))
def parse_citations_json(spark, sf):
    r = view(spark, sf, _CANS).select("k", llmjson.citations("answer").alias("c"))
    return r.select("k", F.size("c").alias("n"), F.get("c", F.lit(0))["article"].alias("article"))


@query("coerce_citations", duck("SELECT k, CAST(CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 0 END AS INT) AS n FROM cases"))
def coerce_citations(spark, sf):
    c = """CASE k % 4 WHEN 0 THEN '{"law_name": "a"}' WHEN 1 THEN '"x"' WHEN 2 THEN '[{"law_name": "a"}, 5, {"article": "b"}]' ELSE '[]' END"""
    return _cases(spark, sf).select("k", F.size(llmjson.coerced_citations(F.expr(c))).alias("n"))


_AP = prompts.AMOUNT_PROMPT.replace("'", "''")


@query("prompt_amount_local", duck(f"SELECT k, replace('{_AP}', '{{question_json}}', concat('{{\"Z4_Reasoning\": \"', z4, '\", \"Z3_Fact\": \"', z3, '\"}}')) AS prompt FROM cases"))
def prompt_amount_local(spark, sf):
    return _cases(spark, sf).select("k", prompts.local_amount("z4", "z3").alias("prompt"))


@query("prompt_amount_chat", duck("SELECT k, concat('【Z4】', chr(10), '\"\"\"', chr(10), z4, chr(10), '\"\"\"', chr(10), chr(10), '【Z3】', chr(10), '\"\"\"', chr(10), z3, chr(10), '\"\"\"') AS prompt FROM cases"))
def prompt_amount_chat(spark, sf):
    return _cases(spark, sf).select("k", prompts.chat_amount("z4", "z3").alias("prompt"))


@query("prompt_law", duck(f"SELECT k, replace('{prompts.LAW_PROMPT}', '{{text}}', z4) AS local, concat('【待抽取文本】', chr(10), '\"\"\"', chr(10), z4, chr(10), '\"\"\"', chr(10), chr(10), '请输出 JSON。') AS chat FROM cases"))
def prompt_law(spark, sf):
    return _cases(spark, sf).select("k", prompts.local_law("z4").alias("local"), prompts.chat_law("z4").alias("chat"))


@query("prompt_fee", duck("SELECT _pos AS pos, concat('【辅助信息】', chr(10), '原告列表：[\"', plaintiff, '\"]', chr(10), '被告列表：[''', defendant, ''']', chr(10), chr(10), '【待分析的费用段落】：', chr(10), '\"\"\"', chr(10), 'a', chr(10), 'b', chr(10), '\"\"\"', chr(10), chr(10), '请根据上述信息，输出标准的 JSON 数据。') AS prompt FROM roles", roles=ROLES))
def prompt_fee(spark, sf):
    texts = F.array(F.lit("a"), F.lit("b"))
    return view(spark, sf, ROLES).select(F.col("_pos").alias("pos"), prompts.chat_fee(texts, F.array("plaintiff"), F.array("defendant")).alias("prompt"))


@query("flatten_text", r"SELECT conv_id, turn, replace(text, chr(10), '\n') AS flat, length(text) AS n FROM conversations")
def flatten_text(spark, sf):
    return _table(spark, sf, "conversations").select("conv_id", "turn", flat("text").alias("flat"), F.length("text").alias("n"))


@query("list_repr_whole", r"SELECT conv_id, turn, concat('[', CASE WHEN strpos(r, '''') > 0 AND strpos(r, '\"') = 0 THEN concat('\"', replace(replace(r, '\', '\\'), chr(10), '\n'), '\"') ELSE concat('''', replace(replace(replace(r, '\', '\\'), chr(10), '\n'), '''', '\'''), '''') END, ', ''x'']') AS r FROM (SELECT conv_id, turn, text AS r FROM conversations)".replace('\\"', '"'))
def list_repr_whole(spark, sf):
    return _table(spark, sf, "conversations").select("conv_id", "turn", list_repr(F.array("text", F.lit("x"))).alias("r"))


_STEM = "regexp_replace(string_split(path, '/')[-1], '[.][^.]+$', '')"
_PAR = "string_split(path, '/')[-2]"


@query("path_year_month", duck(f"""SELECT k, CASE WHEN regexp_matches(s, '\\d{{4}}-\\d{{2}}') THEN regexp_extract(s, '(\\d{{4}})-\\d{{2}}', 1) ELSE p END AS year_a, CASE WHEN regexp_matches(s, '\\d{{4}}-\\d{{2}}') THEN regexp_extract(s, '\\d{{4}}-\\d{{2}}') ELSE s END AS month_a,
  CASE WHEN regexp_matches(s, '^\\d+-') THEN string_split(s, '-')[1] ELSE 'unknown' END AS year_b, CASE WHEN regexp_matches(s, '^\\d+-') THEN array_to_string(string_split(s, '-')[1:2], '-') ELSE s END AS month_b,
  CASE WHEN regexp_matches(s, '^\\d{{4}}') THEN left(s, 4) ELSE p END AS year_c, p AS year_d, concat(p, '/', s, '.json') AS out_path FROM (SELECT k, {_STEM} AS s, {_PAR} AS p FROM cases)"""))
def path_year_month(spark, sf):
    c = _cases(spark, sf)
    a, b = paths.year_month("path"), paths.year_month_of_stem("path")
    return c.select("k", a["year"].alias("year_a"), a["year_month"].alias("month_a"), b["year"].alias("year_b"), b["year_month"].alias("month_b"), paths.year_of_output("path").alias("year_c"), paths.year_of_parent("path").alias("year_d"), paths.output_path("path", "").alias("out_path"))


@query("coalesced_text", duck("SELECT k, CASE WHEN k % 2 = 1 THEN z3 WHEN k % 4 = 0 THEN z4 ELSE '' END AS text FROM cases"))
def coalesced_text(spark, sf):
    from judgex.sources.readers import judgment_text

    c = _cases(spark, sf).selectExpr("k", "CASE WHEN k % 2 = 1 THEN concat(' ', z3) ELSE '' END AS `全文`", "CASE WHEN k % 4 = 0 THEN z4 END AS full_text", "'  ' AS text")
    return c.select("k", judgment_text(c).alias("text"))


@query("blank_filter", duck("SELECT k FROM cases WHERE NOT (k % 3 = 0 AND k % 2 = 0)"))
def blank_filter(spark, sf):
    from judgex.functions.pytext import blank

    c = _cases(spark, sf).selectExpr("k", "CASE WHEN k % 3 = 0 THEN ' \\n' ELSE z3 END AS z3", "CASE WHEN k % 2 = 0 THEN NULL ELSE z4 END AS z4")
    return c.filter(~(blank("z3") & blank("z4"))).select("k")


# --- annotators -------------------------------------------------------------------------------------------------------


@query("annotate_heuristic")
def annotate_heuristic(spark, sf):
    c = _cases(spark, sf).selectExpr("k", "z3", "CASE WHEN k % 50 = 0 THEN NULL ELSE z4 END AS z4").withColumn("z3", F.expr("CASE WHEN k % 50 = 0 THEN '' ELSE z3 END"))
    return annotate.heuristic_amounts(c).select("k", "amount.*", "status", "error_msg")


@query("annotate_model", duck("SELECT k, CASE WHEN bad THEN '' ELSE '50000' END AS target_amount, CASE WHEN bad THEN 'unknown' ELSE '交付金额' END AS amount_type, CASE WHEN bad THEN 'none' ELSE 'Z4' END AS source_zone, CASE WHEN bad THEN 'failed' ELSE 'success' END AS status, 1 AS attempts FROM (SELECT k, contains(concat(z3, z4), '若干') AS bad FROM cases)"))
def annotate_model(spark, sf):
    """A stand-in for a model, which fails on some rows, behind the annotator interface."""

    def model(prompt: str, _: str | None) -> str:
        if "若干" in prompt:
            raise RuntimeError("HTTP 500")
        return '{"target_amount": "5万", "amount_type": "unknown", "source_zone": "Z4"}'

    c = _cases(spark, sf).select("k", "z3", "z4")
    return annotate.answered_amounts(annotate.called(c, prompts.local_amount("z4", "z3"), model)).select("k", "amount.*", "status", "attempts")


@query("rate_limit_waits", "SELECT o_orderkey AS k, o_orderkey % 3 <> 2 AS limited, CAST(least(60, 2 * pow(2, o_orderkey % 7)) AS INT) AS wait FROM orders")
def rate_limit_waits(spark, sf):
    o = _table(spark, sf, "orders").selectExpr("o_orderkey AS k", "CASE o_orderkey % 3 WHEN 0 THEN 'HTTP 429 Error' WHEN 1 THEN 'Too Many Requests' ELSE 'timeout' END AS e", "o_orderkey % 7 AS r")
    return o.select("k", annotate.rate_limited("e").alias("limited"), annotate.wait("r").alias("wait"))


@query("key_rotation", duck("SELECT CAST(CAST(concat('0x', left(md5(cast(k AS STRING)), 8)) AS BIGINT) % 6 AS INT) AS key, count(*) AS n FROM cases GROUP BY 1"))
def key_rotation(spark, sf):
    return _cases(spark, sf).groupBy(annotate.key_number(6, "k").alias("key")).agg(F.count(F.lit(1)).alias("n"))


# --- queries over the analytic tables ---------------------------------------------------------------------------------


@query("label_funnel_by_quality", "SELECT quality, toxic, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2")
def label_funnel_by_quality(spark, sf):
    rows = _table(spark, sf, "labels").join(_table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("event_props", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def event_props(spark, sf):
    return _table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


from judgex.plans import service, storage  # noqa: E402, F401  register their queries here
