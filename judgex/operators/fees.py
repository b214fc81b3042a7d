"""Joins of party roles, fee passages and extracted fees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgex.functions import prompts
from judgex.operators.resume import FILE, last_wins


def _successes(df: DataFrame) -> DataFrame:
    return df.filter("status = 'success' and coalesce(meta.case_no, '') != ''").withColumn("_case", F.col("meta.case_no"))


def merged(roles: DataFrame, fees: DataFrame) -> DataFrame:
    """Fee passages with the parties of their case: rows (file, meta, input_data).

    Cases match by file and case number. Of a case's roles in a file the last counts; fee rows all do. Fee rows without passages go.
    """
    who = last_wins(_successes(roles), [FILE, "_case"], "annotation").withColumnRenamed("annotation", "_role")
    probe = _successes(fees).filter(F.size("annotation.legal_cost_sentences") > 0)
    none = F.array().cast("array<string>")
    data = F.struct(
        F.coalesce("_role.plaintiff", none).alias("plaintiffs"), F.coalesce("_role.defendant", none).alias("defendants"), F.col("annotation.legal_cost_sentences").alias("cost_texts")
    )
    return probe.join(who, [FILE, "_case"]).select(FILE, "meta", data.alias("input_data"))


def training_rows(finals: DataFrame, roles: DataFrame, fees: DataFrame, limit: int = prompts.FEE_LIMIT) -> DataFrame:
    """Samples of extracted fees: rows (file, case_no, sample, fits). ``finals`` has result_json, the result's raw text."""
    who = last_wins(_successes(roles), [FILE, "_case"], "annotation").select(FILE, "_case", F.col("annotation").alias("_role"))
    texts = last_wins(_successes(fees), [FILE, "_case"], "annotation").select(FILE, "_case", F.col("annotation.legal_cost_sentences").alias("_texts"))
    rows = _successes(finals).withColumn(FILE, F.replace(FILE, F.lit("result_final_"), F.lit("result_")))
    rows = rows.filter("result_json is not null and result_json like '{%' and result_json != '{}'").join(who, [FILE, "_case"]).join(texts, [FILE, "_case"]).filter(F.size("_texts") > 0)
    none = F.array().cast("array<string>")
    s = prompts.fee_sample(F.coalesce("_role.plaintiff", none), F.coalesce("_role.defendant", none), F.col("_texts"), F.col("result_json"))
    return rows.select(FILE, F.col("_case").alias("case_no"), s.alias("sample")).withColumn("fits", F.col("sample.length") <= limit)


def burdens(finals: DataFrame) -> DataFrame:
    """Rows (payer_role, liability_type, cases, payers, total) over all extracted fees."""
    each = _successes(finals).select("_case", F.explode("extraction_result.burden_distribution").alias("b"))
    return each.groupBy("b.payer_role", "b.liability_type").agg(
        F.countDistinct("_case").alias("cases"), F.count(F.lit(1)).alias("payers"), F.sum(F.col("b.total_burden_amount").cast("decimal(18,2)")).alias("total")
    )
