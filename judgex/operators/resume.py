"""Deduplication, resuming of interrupted runs, and limits whose meaning depends on order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judgex.functions.paths import parts
from judgex.functions.pytext import key

FILE, POS = "_file", "_pos"


def _order() -> list[Column]:
    return [parts(FILE), F.col(POS)]


def first_wins(df: DataFrame, by: str = "case_no") -> DataFrame:
    """The first row of each key, in order of file and position; rows without a key all stay.

    Rows without a key are dealt by position, so they are no single group.
    """
    k = key(by)
    spread = F.when(k == "", F.concat_ws("\x00", FILE, POS)).otherwise(k)
    w = Window.partitionBy(spread).orderBy(*_order())
    return df.withColumn("_rank", F.row_number().over(w)).filter((F.col("_rank") == 1) | (k == "")).drop("_rank")


def last_wins(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows (*keys, value) with the value of the last row of each key: a map-side combined aggregate."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*_order())).alias(value))


#: How completed work is recognised, by kind of run: columns of the key.
RESUME_KEYS = {"case": ("case_no",), "file_case": ("source_file", "case_no"), "file_case_sample": ("source_file", "case_no", "sample_id")}


def resume_key(kind: str) -> Column:
    """A run's key: case_no alone, or several columns joined by ::; "" where all are empty."""
    cols = RESUME_KEYS[kind]
    if len(cols) == 1:
        return key(cols[0])
    joined = F.concat_ws("::", *(key(c) for c in cols))
    return F.when(F.replace(joined, F.lit(":"), F.lit("")) == "", "").otherwise(joined)


def remaining(df: DataFrame, done: DataFrame, kind: str = "case", only_success: bool = False) -> DataFrame:
    """Rows whose key isn't completed; rows without a key are never completed. ``only_success`` retries what failed."""
    finished = done.filter("status = 'success'") if only_success else done
    finished = finished.select(resume_key(kind).alias("_done")).filter("_done != ''").distinct()
    return df.withColumn("_key", resume_key(kind)).join(finished, F.col("_key") == F.col("_done"), "left_anti").drop("_key")


def completed(index: DataFrame, outputs: DataFrame) -> DataFrame:
    """Keys in a run's index or in its outputs."""
    return index.select(key("case_no").alias("case_no")).union(outputs.select(key("case_no").alias("case_no"))).filter("case_no != ''").distinct()


def salvaged_keys(text: Column | str) -> Column:
    """All case numbers in the text of a broken JSON file."""
    return F.regexp_extract_all(text if isinstance(text, Column) else F.col(text), F.lit(r'"case_no"\s*:\s*"([^"]+)"'), F.lit(1))


def unseen(existing: DataFrame, new: DataFrame, kind: str = "file_case") -> DataFrame:
    """Rows of ``new`` whose keys ``existing`` lacks, the first of each key; rows without a key can't be told apart and are all new.

    These don't take part in the join or the ranking, so however many there are, they form no group.
    """
    fresh = new.withColumn("_key", resume_key(kind))
    keyless = fresh.filter("_key = ''").drop("_key")
    old = existing.select(resume_key(kind).alias("_key")).filter("_key != ''").distinct()
    fresh = fresh.filter("_key != ''").join(old, "_key", "left_anti")
    w = Window.partitionBy("_key").orderBy(*_order()) if {FILE, POS} <= set(new.columns) else Window.partitionBy("_key").orderBy(*new.columns)
    return fresh.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").select(new.columns).unionAll(keyless)


def upsert(existing: DataFrame, new: DataFrame, kind: str = "file_case") -> DataFrame:
    """Existing rows, and new ones with unseen keys, the first of each key."""
    return existing.unionByName(unseen(existing, new, kind), allowMissingColumns=True)


def take(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in order of file and position."""
    return df.orderBy(*_order()).limit(n)


def take_up_to(df: DataFrame, total: int, already: int) -> DataFrame:
    """As many of the first rows as reach a total, counting those already done."""
    return take(df, max(0, total - already))


def rows_per_file(df: DataFrame, n: int) -> DataFrame:
    """Rows among the first n of their file; positions count every row."""
    return df.filter(F.col(POS) < n)


def first_files(df: DataFrame, n: int) -> DataFrame:
    """Rows of the first n files in path order."""
    files = df.select(FILE).distinct().orderBy(parts(FILE)).limit(n)
    return df.join(files, FILE, "left_semi")


def until_valid(df: DataFrame, valid: Column, n: int) -> DataFrame:
    """The rows scanned until the n-th valid one, in order of file and position.

    Per-file counts are summed up first, so the running count is by file, never over all rows at once.
    """
    marked = df.withColumn("_ok", valid.cast("int"))
    files = marked.groupBy(FILE).agg(F.sum("_ok").alias("_n"))
    before = Window.orderBy(parts(FILE)).rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = files.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(FILE, "_before").filter(F.col("_before") < n)
    within = Window.partitionBy(FILE).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    counted = marked.join(files, FILE).withColumn("_seen", F.col("_before") + F.coalesce(F.sum("_ok").over(within), F.lit(0)))
    return counted.filter(F.col("_seen") < n).drop("_ok", "_before", "_seen")


def seeded_sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows, the same for a seed whatever the partitioning: those with the least md5 of seed and keys."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *keys)), *keys).limit(n)


def first_of_each(df: DataFrame, n: int, by: list[str], *order: Column | str) -> DataFrame:
    """The first n rows of each group. Spark stops at n rows a group before the shuffle, so a hot group moves n rows a task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of all; each task keeps n at most."""
    return df.orderBy(*order).limit(n)
