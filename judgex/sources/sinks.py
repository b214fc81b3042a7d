"""Writers: partitioned JSON, JSON lines, sample text, audits, run metadata."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions import prompts
from judgex.operators.resume import unseen
from judgex.sources.files import Files, name


def _month_folders(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(year, year_month) of the folders of a partitioned tree: names are listed, rows aren't read."""
    files = Files(spark)
    value = lambda folder, key: unquote(name(folder).removeprefix(f"{key}="))
    return [(value(y.path, "year"), value(m.path, "year_month")) for y in files.entries(path) if name(y.path).startswith("year=") for m in files.entries(y.path) if name(m.path).startswith("year_month=")]


def json_by_month(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines partitioned by year and year_month; months that exist are kept, or with ``overwrite`` replaced."""
    if not overwrite:
        if have := _month_folders(df.sparkSession, path):
            df = df.join(df.sparkSession.createDataFrame(have, "year string, year_month string"), ["year", "year_month"], "left_anti")
        df.write.mode("append").partitionBy("year", "year_month").json(path)
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "year_month").json(path)


def json_arrays_by_month(df: DataFrame, path: str) -> None:
    """One text row a month, [\\n…,\\n…\\n]: for readers that want whole arrays. A month must fit in memory."""
    row = F.to_json(F.struct(*(c for c in df.columns if c not in ("year", "year_month", "_order"))), {"ignoreNullFields": "false"})
    order = F.col("_order") if "_order" in df.columns else F.monotonically_increasing_id()
    months = df.select("year", "year_month", F.struct(order.alias("o"), row.alias("j")).alias("r")).groupBy("year", "year_month").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    text = F.concat(F.lit("[\n"), F.array_join(F.transform("rs", lambda r: r["j"]), ",\n"), F.lit("\n]"))
    months.select("year", "year_month", text.alias("value")).write.mode("overwrite").partitionBy("year", "year_month").text(path)


def sample_text(samples: DataFrame, path: str) -> None:
    """Samples as 指令, 问 and 答 lines with an empty line after each; ``samples`` has a struct ``sample``."""
    samples.select(prompts.lines(F.col("sample"))).write.mode("overwrite").text(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def audits(gated_rows: DataFrame, path: str) -> None:
    """All rejected rows, partitioned by outcome."""
    rejected = gated_rows.filter("outcome != 'valid'")
    lengths = F.struct(F.length("sample.instruction").alias("instruction_len"), F.length("sample.question").alias("question_len"), F.length("sample.answer").alias("answer_len"))
    rejected.withColumn("lengths", F.when(F.col("outcome") == "overlength", lengths)).drop("sample").write.mode("overwrite").partitionBy("outcome").json(path)


def merge(existing: DataFrame, new: DataFrame, path: str, kind: str = "file_case") -> None:
    """Append the rows of ``new`` whose keys ``existing`` (read from ``path``) lacks."""
    unseen(existing, new, kind).write.mode("append").json(path)


def run_summary(df: DataFrame, **arguments: object) -> DataFrame:
    """One row: counts by status, and the run's arguments."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped")))
    return counts.select("*", *(F.lit(v).alias(k) for k, v in arguments.items()), F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss").alias("run_id"))
