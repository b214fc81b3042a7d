"""JSON lines by month, with skip-if-exists, append, overwrite and repair; stored rows are never read to find out what is there.

A run is written to a staging folder and then moved in, a month at a time, as ``year=Y/year_month=M/run=R``. A month is there once its
folder is, so listing folders tells what is done. A run that was interrupted while it wrote is taken back by the next one's
``repair``; one that was interrupted while months were moved is finished, as its staging folder is complete. Both may happen any number of times. Moves are
atomic where the file system renames atomically; object stores copy, where a reader may see part of a month.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions.paths import parts
from judgex.operators.resume import FILE
from judgex.sources.files import Files, name

SKIP, APPEND, OVERWRITE = "skip", "append", "overwrite"
_STAGING = "_staging"


def _month_folders(files: Files, path: str) -> list[str]:
    return [m.path for y in files.entries(path) if y.is_folder and name(y.path).startswith("year=") for m in files.entries(y.path) if m.is_folder]


def months(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(year, year_month) of the months that are there."""
    files = Files(spark)
    found = [m for m in _month_folders(files, path) if any(name(r.path).startswith("run=") for r in files.entries(m))]
    return [(name(m.rsplit("/", 1)[0]).removeprefix("year="), name(m).removeprefix("year_month=")) for m in found]


def first_files(df: DataFrame) -> DataFrame:
    """The rows of each month's first file, in path order: a later file of the same month is skipped."""
    first = df.groupBy("year", "year_month").agg(F.min(F.struct(parts(FILE), F.col(FILE).alias("f"))).alias("_first"))
    return df.join(first, ["year", "year_month"]).filter(F.col(FILE) == F.col("_first.f")).drop("_first")


def _publish(files: Files, path: str, stage: str, mode: str, run: str) -> None:
    for month in _month_folders(files, f"{stage}/data"):
        y, m = name(month.rsplit("/", 1)[0]), name(month)
        target = f"{path}/{y}/{m}"
        others = [r.path for r in files.entries(target) if name(r.path) != f"run={run}"]
        if mode == SKIP and others:
            continue
        files.rename(month, f"{target}/run={run}")
        if mode == OVERWRITE:
            for r in others:
                files.delete(r)
    files.delete(stage)


def repair(spark: SparkSession, path: str) -> dict[str, str]:
    """What became of interrupted runs: finished or taken back."""
    files, out = Files(spark), {}
    for s in files.entries(f"{path}/{_STAGING}"):
        run = name(s.path)
        mode = next((name(e.path).removeprefix("mode-") for e in files.entries(s.path) if name(e.path).startswith("mode-")), None)
        if mode and files.exists(f"{s.path}/data/_SUCCESS"):
            # overwrites may have moved months without removing what they replace
            if mode == OVERWRITE:
                for m in _month_folders(files, path):
                    runs = [r.path for r in files.entries(m)]
                    if any(name(r) == f"run={run}" for r in runs):
                        for r in runs:
                            if name(r) != f"run={run}":
                                files.delete(r)
            _publish(files, path, s.path, mode, run)
            out[run] = "finished"
        else:
            files.delete(s.path)
            out[run] = "taken back"
    return out


def write(df: DataFrame, path: str, mode: str = SKIP, run: str | None = None) -> str:
    """Write rows with year and year_month, and with ``skip`` also ``_file``; gives the run's name.

    ``skip`` keeps months that are there and takes one file a month; ``append`` adds to months; ``overwrite`` replaces the months that ``df`` has.
    """
    if mode not in (SKIP, APPEND, OVERWRITE):
        raise ValueError(f"unknown mode: {mode}")
    spark, path = df.sparkSession, path.rstrip("/")
    repair(spark, path)
    run, files = run or uuid.uuid4().hex, Files(spark)
    if mode == SKIP:
        df = first_files(df) if FILE in df.columns else df
        if have := months(spark, path):
            df = df.join(spark.createDataFrame(have, "year string, year_month string"), ["year", "year_month"], "left_anti")
    stage = f"{path}/{_STAGING}/{run}"
    files.touch(f"{stage}/mode-{mode}")
    df.write.partitionBy("year", "year_month").option("ignoreNullFields", False).json(f"{stage}/data")
    _publish(files, path, stage, mode, run)
    return run


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all months, with year, year_month and run."""
    return spark.read.schema(f"{schema}, year string, year_month string, run string").json(path)
