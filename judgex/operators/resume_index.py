"""Completed keys kept in buckets, so that a resumed run's join doesn't move them again.

The index is a table of keys, hashed into a fixed number of buckets when they are added. Spark joins it without an exchange on its
side: each task reads the buckets it needs. Only the rows to be processed are shuffled, by key, to as many partitions. Choose ``buckets`` at least
``spark.sql.shuffle.partitions``, or Spark prefers to deal both sides anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.operators.resume import resume_key


class ResumeIndex:
    """An index under ``path``, known to the session's catalog as ``table``. It outlives the session: opening it again finds its keys."""

    def __init__(self, spark: SparkSession, table: str, path: str, buckets: int):
        self.spark, self.table, self.path, self.buckets = spark, table, path, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (done STRING) USING parquet CLUSTERED BY (done) SORTED BY (done) INTO {buckets} BUCKETS LOCATION '{path}'")

    def add(self, df: DataFrame, kind: str, only_success: bool = False) -> None:
        """Add the keys of finished rows; rows without a key are never finished. Keys that are there already do no harm."""
        rows = df.filter("status = 'success'") if only_success else df
        keys = rows.select(resume_key(kind).alias("done")).filter("done != ''").distinct()
        keys.repartition(self.buckets, "done").write.mode("append").format("parquet").bucketBy(self.buckets, "done").sortBy("done").option("path", self.path).saveAsTable(self.table)

    def keys(self) -> DataFrame:
        return self.spark.table(self.table)

    def remaining(self, df: DataFrame, kind: str) -> DataFrame:
        """Rows whose key isn't in the index."""
        left = df.withColumn("_key", resume_key(kind))
        return left.join(self.keys(), F.col("_key") == F.col("done"), "left_anti").drop("_key")

    def drop(self) -> None:
        """Forget the table; the keys stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
