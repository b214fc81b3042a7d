"""Building training samples: joins of labels with texts, gates in order, audits, the funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judgex.functions import citations, prompts
from judgex.functions.amounts import DELIVERED, INVOLVED, NUMBER
from judgex.functions.paths import parts
from judgex.functions.pytext import key, strip
from judgex.operators.resume import FILE, POS

#: Outcomes of the gates in order; the first that applies wins.
OUTCOMES = ("empty_case_no", "duplicate", "missing", "ambiguous", "invalid_or_filtered_amount", "overlength", "valid")


def normal_label(include_unknown: bool = False) -> dict[str, Column]:
    """target_amount, amount_type, source_zone of a label row, and ok, whether they make a valid label."""
    a = strip(F.coalesce(F.nullif("target_amount", F.lit("")), F.lit("")))
    t, z = strip(F.coalesce(F.nullif("amount_type", F.lit("")), F.lit("unknown"))), strip(F.coalesce(F.nullif("source_zone", F.lit("")), F.lit("none")))
    good = a.rlike(rf"\A{NUMBER}\z")
    kind = F.when(good & t.isin(DELIVERED, INVOLVED), t).otherwise("unknown")
    zone = F.when(good & z.isin("Z4", "Z3"), z).otherwise("none")
    ok = good & (kind != "unknown") & (zone != "none")
    return {"target_amount": F.when(good, a).otherwise(""), "amount_type": kind, "source_zone": zone, "ok": (ok | (kind == "unknown")) if include_unknown else ok}


def gated(labels: DataFrame, texts: DataFrame, include_unknown: bool = False, limit: int = prompts.AMOUNT_LIMIT) -> DataFrame:
    """Every label row with its outcome and, where it comes so far, its sample.

    ``labels``: file, position, case_no, target_amount, amount_type, source_zone. ``texts``: file, position, case_no, z4, z3.
    Rows: file, position, case_no, candidate_count, the normalised label, sample, outcome. Texts are counted by case first
    (combined on the map side), so the join is one to one.
    """
    k = key("case_no")
    by_case = texts.withColumn("_case", k).filter("_case != ''").groupBy("_case").agg(
        F.count(F.lit(1)).alias("candidate_count"), F.min_by(F.struct("z4", "z3"), F.struct(parts(FILE), F.col(POS))).alias("_text")
    )
    spread = F.when(k == "", F.concat_ws("\x00", FILE, POS)).otherwise(k)
    nth = F.row_number().over(Window.partitionBy(spread).orderBy(parts(FILE), POS))
    rows = labels.withColumn("_case", k).withColumn("_nth", nth).join(by_case, "_case", "left")
    norm = normal_label(include_unknown)
    rows = rows.withColumns({"_ok": norm.pop("ok")}).withColumns(norm)
    sample = prompts.amount_sample(strip(F.coalesce("_text.z4", F.lit(""))), strip(F.coalesce("_text.z3", F.lit(""))), F.col("target_amount"), F.col("amount_type"), F.col("source_zone"))
    rows = rows.withColumn("sample", F.when((F.col("candidate_count") == 1) & F.col("_ok"), sample))
    outcome = (
        F.when(F.col("_case") == "", OUTCOMES[0])
        .when(F.col("_nth") > 1, OUTCOMES[1])
        .when(F.col("candidate_count").isNull(), OUTCOMES[2])
        .when(F.col("candidate_count") > 1, OUTCOMES[3])
        .when(~F.col("_ok"), OUTCOMES[4])
        .when(F.col("sample.length") > limit, OUTCOMES[5])
        .otherwise(OUTCOMES[6])
    )
    return rows.select(FILE, POS, F.col("_case").alias("case_no"), F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"), "target_amount", "amount_type", "source_zone", "sample", outcome.alias("outcome"))


def funnel(gated_rows: DataFrame) -> DataFrame:
    """One row: how many labels met each outcome; total is their sum."""
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return gated_rows.agg(
        F.count(F.lit(1)).alias("total"), n("valid").alias("valid"), n("missing").alias("missing"), n("ambiguous").alias("ambiguous"), n(OUTCOMES[0], OUTCOMES[4]).alias("invalid"),
        n("overlength").alias("overlength"), n("duplicate").alias("duplicate"), F.countDistinct(F.nullif("case_no", F.lit(""))).alias("unique_case_no"),
    )


def samples(gated_rows: DataFrame) -> DataFrame:
    """Valid samples without prefixes: rows (case_no, instruction, question, answer, amount_type, source_zone)."""
    cut = lambda c, prefix: F.substring(f"sample.{c}", len(prefix) + 1, 1 << 30).alias(c)
    return gated_rows.filter("outcome = 'valid'").select(
        "case_no", cut("instruction", prompts.INSTRUCTION), cut("question", prompts.QUESTION), cut("answer", prompts.ANSWER), "amount_type", "source_zone"
    )


def law_samples(rows: DataFrame, limit: int = prompts.LAW_LIMIT, normal: bool = True) -> DataFrame:
    """Rows (source_file, case_no, resolved, ambiguous, aligned, pairs, sample, outcome) of rows with text and citations.

    Alignment is audited only. Outcomes: no_text, no_citations, no_pairs, overlength, valid. ``normal`` compares NFKC text (Python).
    """
    text = strip(F.coalesce("Z4_Reasoning", F.lit("")))
    rows = rows.withColumn("_text", text).withColumn("_normal", citations.normalized(F.col("_text"), already_nfkc=not normal))
    rows = rows.withColumn("_r", citations.resolved("citations"))
    found = F.filter("_r.resolved", lambda c: citations.aligned(F.col("_text"), F.col("_normal"), c))
    rows = rows.withColumn("aligned", found).withColumn("pairs", citations.cleaned("_r.resolved")).withColumn("sample", prompts.law_sample(F.col("_text"), F.col("pairs")))
    outcome = (
        F.when(F.col("_text") == "", "no_text").when(F.coalesce(F.size("citations"), F.lit(0)) <= 0, "no_citations").when(F.size("pairs") == 0, "no_pairs")
        .when(F.col("sample.length") > limit, "overlength").otherwise("valid")
    )
    return rows.select("source_file", "case_no", F.col("_r.resolved").alias("resolved"), F.col("_r.ambiguous").alias("ambiguous"), "aligned", "pairs", "sample", outcome.alias("outcome"))
