"""Files and folders on any file system that Spark reads, through Hadoop's client; listings as DataFrames.

Listings keep the natural order of paths, by components. An excluded folder is left out before anything is scanned: its
siblings are read instead of its parents.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions.paths import parts
from judgex.operators.resume import FILE


class Entry(NamedTuple):
    path: str
    is_folder: bool


class Files:
    """What a driver does with single files and folders. Paths may be of any scheme; without one they are of the default file system."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def qualified(self, path: str) -> str:
        fs, p = self._at(path)
        return fs.makeQualified(p).toString()

    def entries(self, folder: str) -> list[Entry]:
        """A folder's own entries in the order of their names; none if it isn't there."""
        fs, p = self._at(folder)
        if not fs.exists(p):
            return []
        return sorted(Entry(s.getPath().toString(), s.isDirectory()) for s in fs.listStatus(p))

    def rename(self, old: str, new: str) -> None:
        """Move a file or folder to a path that isn't there yet, whose parent is made."""
        fs, a = self._at(old)
        _, b = self._at(new)
        if fs.exists(b):
            raise FileExistsError(new)
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise OSError(f"can't rename {old} to {new}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def touch(self, path: str) -> None:
        fs, p = self._at(path)
        fs.create(p, True).close()


def name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def roots(spark: SparkSession, folder: str, exclude: str | None = None) -> list[str]:
    """The paths that make up a tree but for an excluded folder inside it: the siblings along the way to it."""
    files = Files(spark)
    base, skip = files.qualified(folder).rstrip("/"), files.qualified(exclude).rstrip("/") if exclude else ""
    if not (skip + "/").startswith(base + "/"):
        return [base]
    out, at = [], base
    while at != skip:
        inside = files.entries(at)
        down = [e.path.rstrip("/") for e in inside if (skip + "/").startswith(e.path.rstrip("/") + "/")]
        out += [e.path for e in inside if e.path.rstrip("/") not in down]
        if not down:
            break
        at = down[0]
    return out


def listed(spark: SparkSession, folder: str, glob: str = "*", exclude: str | None = None) -> DataFrame:
    """Rows (_file, length) of the files of a tree whose names match; contents aren't opened."""
    found = roots(spark, folder, exclude)
    if not found:
        return spark.createDataFrame([], f"{FILE} string, length long")
    # with a name filter, single files given as roots must match it, too
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(found)
    return df.select(F.col("path").alias(FILE), "length")


def ordered(files: DataFrame) -> DataFrame:
    """Files in natural order."""
    return files.orderBy(parts(FILE))


def text_of(spark: SparkSession, path: str) -> str:
    """A small file's text, without a byte order mark."""
    row = spark.read.text(path, wholetext=True).first()
    return (row[0] if row else "").removeprefix("﻿")


def input_folder(spark: SparkSession, base: str, explicit: str | None = None, run: str | None = None) -> str:
    """An input folder: the explicit one, or a named run's, or the run that latest_run.txt names."""
    if explicit:
        return explicit
    if run:
        return f"{base.rstrip('/')}/{run}"
    latest = f"{base.rstrip('/')}/latest_run.txt"
    if Files(spark).exists(latest) and (found := text_of(spark, latest).strip()):
        return found if "/" in found else f"{base.rstrip('/')}/{found}"
    raise FileNotFoundError(f"no folder, run or latest_run.txt under {base}")


def vocabulary(spark: SparkSession, path: str) -> dict[str, int]:
    """A character vocabulary: a JSON object that holds <pad> and <unk>."""
    import json

    found = json.loads(text_of(spark, path))
    if missing := {"<pad>", "<unk>"} - set(found):
        raise ValueError(f"vocabulary lacks {sorted(missing)}")
    return found
