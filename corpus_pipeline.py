"""A training corpus from raw documents: five stages, each one operator of ``judgex.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's ``docs``. All but the last return the columns of ``documents``. Stages work on everything their
predecessor kept; null or empty texts and empty tables go through as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm import decontamination, jaccard, mixing, quality, spans
from judgex.session import cut

#: Near-duplicates: five-word shingles, similarity 0.8 or more.
NEAR = jaccard.Rule(k=5, percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return jaccard.first_of_each(docs, NEAR)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated spans go from all documents but the first that has them; n_chars follows."""
    out = spans.strip(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontamination.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each remaining document, and when, in training order."""
    return mixing.mix(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_spans),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]

#: The tokenizer and sketch stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
