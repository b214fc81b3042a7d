"""Scans of CSV, JSON and JSONL trees. Every row carries its file (``_file``) and place in it (``_pos``, from 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.functions.pytext import SPACE, filled, strip
from judgex.operators.resume import FILE, POS

_BOM = "\ufeff"


def _files(spark: SparkSession, path: str, glob: str, exclude: str | None = None) -> DataFrame:
    """Whole files as text: rows (_file, _text), without a byte order mark. ``exclude`` leaves out a nested folder."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias(FILE), F.regexp_replace("value", f"\\A{_BOM}", "").alias("_text"))
    return df.filter(~F.contains(FILE, F.lit("/" + exclude.strip("/") + "/"))) if exclude else df


def csv_tree(spark: SparkSession, path: str, columns: list[str] | None = None, glob: str = "*.csv") -> DataFrame:
    """CSV files with quoted line breaks; headers lose a byte order mark. All columns are strings.

    ``columns`` avoids looking at the data for a header. ``_pos`` counts the rows of a file, empty ones too.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("encoding", "UTF-8")
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns)).option("enforceSchema", False)
    df = reader.csv(path)
    names = [c.lstrip(_BOM) for c in df.columns]
    rows = df.select("*", F.col("_metadata.file_path").alias(FILE), F.monotonically_increasing_id().alias("_id")).toDF(*names, FILE, "_id")
    # a multi-line CSV file is one task's, so ids rise within a file; its first id is found by an aggregate, a row a file, and no row moves to meet it
    first = rows.groupBy(FILE).agg(F.min("_id").alias("_first"))
    return rows.join(F.broadcast(first), FILE).withColumn(POS, F.col("_id") - F.col("_first")).drop("_id", "_first")


def judgment_text(df: DataFrame, names: tuple[str, ...] = ("全文", "full_text", "text"), stripped: bool = True) -> Column:
    """The first filled text column of those that exist."""
    have = [df[c] for c in names if c in df.columns]
    text = filled(*have) if have else F.lit("")
    return strip(text) if stripped else text


def _exploded(files: DataFrame, text: Column, schema: str) -> DataFrame:
    """The elements that are objects of an array text, as columns."""
    items = files.withColumn("_text", text).withColumn("_raw", F.from_json("_text", "array<string>", {"mode": "PERMISSIVE"}))
    rows = items.select(FILE, F.posexplode("_raw").alias(POS, "_item")).filter(F.col("_item").rlike(rf"\A[{SPACE}]*\{{"))
    return rows.select(FILE, POS, F.col("_item").alias("_json"), F.from_json("_item", schema).alias("_r")).select("_r.*", FILE, POS, "_json")


def recovered(text: Column) -> Column:
    """An array text; a truncated one is cut after its last } and closed, and one without its opening bracket gets it."""
    s = strip(text)
    body = F.regexp_extract(s, r"(?s)\A(.*\})", 1)
    fixed = F.concat(F.when(body.startswith("["), "").otherwise("["), body, F.lit("]"))
    return F.when(F.try_parse_json(s).isNotNull(), s).when(body != "", fixed)


def json_arrays(spark: SparkSession, path: str, schema: str, recover: bool = False, glob: str = "*.json", exclude: str | None = None) -> DataFrame:
    """Files that hold an array of objects. Files that can't be parsed are left out, or with ``recover`` repaired."""
    files = _files(spark, path, glob, exclude)
    text = recovered(F.col("_text")) if recover else F.when(F.try_parse_json("_text").isNotNull(), strip("_text"))
    return _exploded(files.filter(text.startswith("[")), text, schema)


def json_lines(spark: SparkSession, path: str, schema: str, glob: str = "*.jsonl") -> DataFrame:
    """One object a line; blank and broken lines are skipped. Lines keep their place.

    Lines are cut from whole files, since places are asked for; ``json_lines_splittable`` reads any size without them.
    """
    files = _files(spark, path, glob)
    rows = files.select(FILE, F.posexplode(F.split("_text", r"\r?\n")).alias(POS, "_json"))
    return _parsed_lines(rows, schema)


def json_lines_splittable(spark: SparkSession, path: str, schema: str, glob: str = "*.jsonl") -> DataFrame:
    """As ``json_lines``, in splits of any file size; ``_pos`` rises within a file but isn't the line number."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    return _parsed_lines(rows.select(F.col("_metadata.file_path").alias(FILE), F.monotonically_increasing_id().alias(POS), F.col("value").alias("_json")), schema)


def _parsed_lines(rows: DataFrame, schema: str) -> DataFrame:
    rows = rows.filter(F.try_parse_json("_json").isNotNull() & F.col("_json").rlike(rf"\A[{SPACE}\ufeff]*\{{"))
    return rows.select(F.from_json("_json", schema).alias("_r"), FILE, POS, "_json").select("_r.*", FILE, POS, "_json")


def json_mixed(spark: SparkSession, path: str, schema: str, exclude: str | None = None) -> DataFrame:
    """.json files with an array or one object, and .jsonl files; a .jsonl file with any broken line is left out."""
    arrays = json_arrays(spark, path, schema, exclude=exclude)
    single = _files(spark, path, "*.json", exclude)
    single = single.filter(F.try_parse_json("_text").isNotNull() & strip("_text").startswith("{"))
    single = single.select(F.from_json("_text", schema).alias("_r"), FILE, F.lit(0).alias(POS), F.col("_text").alias("_json")).select("_r.*", FILE, POS, "_json")
    lines = _files(spark, path, "*.jsonl", exclude).withColumn("_lines", F.filter(F.split("_text", r"\r?\n"), lambda x: strip(x) != ""))
    whole = lines.filter(F.forall("_lines", lambda x: F.try_parse_json(x).isNotNull()))
    rows = whole.select(FILE, F.posexplode("_lines").alias(POS, "_json"))
    return arrays.unionByName(single).unionByName(_parsed_lines(rows, schema))


def vocabulary(path: str) -> dict[str, int]:
    """A character vocabulary: a JSON object that holds <pad> and <unk>."""
    import json

    with open(path, encoding="utf-8-sig") as f:
        found = json.load(f)
    if missing := {"<pad>", "<unk>"} - set(found):
        raise ValueError(f"vocabulary lacks {sorted(missing)}")
    return found


def run_folder(base: str, explicit: str | None = None, run: str | None = None) -> str:
    """An input folder: the explicit one, or a named run's, or the run that latest_run.txt names."""
    from pathlib import Path

    if explicit:
        return explicit
    if run:
        return f"{base}/{run}"
    latest = Path(base, "latest_run.txt")
    if latest.exists() and (name := latest.read_text(encoding="utf-8-sig").strip()):
        return name if "/" in name else f"{base}/{name}"
    raise FileNotFoundError(f"no folder, run or latest_run.txt under {base}")
