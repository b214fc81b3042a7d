"""Queries over readers, sinks, the resume index and the boundary scorer. Trees of files are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from judgex.functions import paths, zones
from judgex.operators import resume, scorer
from judgex.operators.resume_index import ResumeIndex
from judgex.plans.cases import CASES, CITED, duck, view
from judgex.plans.queries import query
from judgex.session import scratch
from judgex.sources import arrays, files, months, readers

# --- trees of files ---------------------------------------------------------------------------------------------------

#: One JSON text a case, with what strings may hold: braces, quotes, backslashes, line ends.
_ROWS = """
SELECT k, 2010 + k % 7 AS y, concat('{"k": ', cast(k AS STRING), ', "z4": "', z4, '", "odd": "', CASE k % 4 WHEN 0 THEN '}{' WHEN 1 THEN concat(chr(92), '"}') WHEN 2 THEN concat(chr(92), 'n]') ELSE '' END, '"}') AS j FROM cases
"""


#: Keys of neighbouring cases in a run, within which places are counted before they are counted over runs.
_RUN = 10_000


def _array_tree(spark: SparkSession, sf: str, share: float = 1.0) -> str:
    """A file a year with an array of its cases, a line each, cut off after a share of its characters.

    A file is written line by line from sorted rows; no row or group holds an array. Where a line begins follows from the sizes of runs of lines.
    """
    rows = view(spark, sf, _ROWS).withColumn("run", F.expr(f"k div {_RUN}")).withColumn("n", (F.length("j") + 2).cast("long"))
    year = Window.partitionBy("y")
    runs = rows.groupBy("y", "run").agg(F.sum("n").alias("own"))
    runs = runs.select(  # a row a run
        "y", "run", F.coalesce(F.sum("own").over(year.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("own").over(year).alias("all"),
        (F.col("run") == F.min("run").over(year)).alias("first"), (F.col("run") == F.max("run").over(year)).alias("last"),
    )
    own = Window.partitionBy("y", "run").orderBy("k")
    rows = rows.withColumns({"before": F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "i": F.row_number().over(own), "next": F.lead("k").over(own)}).join(runs, ["y", "run"])
    first, last = F.col("first") & (F.col("i") == 1), F.col("last") & F.col("next").isNull()
    line = F.concat(F.when(first, "[\n").otherwise(""), "j", F.when(last, "\n]").otherwise(","))
    # the whole text: "[\n", lines with ",\n" between them, "\n]"
    left = F.floor((F.col("all") + 2) * share) - F.when(first, 0).otherwise(F.col("base") + F.col("before") + 2)
    lines = rows.select("y", "k", left.alias("left"), line.alias("line")).filter("left >= 0")
    lines = lines.select("y", "k", F.when(F.length("line") > F.col("left"), F.substring("line", F.lit(1), F.col("left").cast("int"))).otherwise(F.col("line")).alias("value"))
    path = scratch(spark, "array-tree")
    lines.repartitionByRange("y").sortWithinPartitions("y", "k").select("y", "value").write.partitionBy("y").text(path)
    return path


@query("json_array_scan", duck(r"SELECT k, y, z4, row_number() OVER (PARTITION BY y ORDER BY k) - 1 AS pos, odd FROM (SELECT k, CAST(2010 + k % 7 AS INT) AS y, z4, CASE k % 4 WHEN 0 THEN '}{' WHEN 1 THEN chr(34) || '}' WHEN 2 THEN chr(10) || ']' ELSE '' END AS odd FROM cases)"))
def json_array_scan(spark, sf):
    """Whole arrays, a file a year, read in byte ranges."""
    df = arrays.json_arrays(spark, _array_tree(spark, sf), "k long, z4 string, odd string", glob="*.txt")
    return df.select("k", F.regexp_extract("_file", r"y=(\d+)", 1).cast("int").alias("y"), "z4", F.col("_pos").alias("pos"), "odd")


@query("json_array_recovered", duck(r"""
  SELECT k, y FROM (SELECT k, y, 2 + sum(length(j) + 2) OVER (PARTITION BY y ORDER BY k) - 2 AS e, floor((3 + sum(length(j) + 2) OVER (PARTITION BY y) - 1) * 0.75) AS cut, j FROM rows)
  WHERE e <= cut AND y IN (SELECT y FROM last WHERE whole)""",
  rows=_ROWS,
  last=r"""
  SELECT y, bool_and(strpos(rest, '}') = 0) AS whole FROM (
    SELECT y, substr(j, 1, CAST(greatest(0, cut - b) AS BIGINT)) AS rest FROM (
      SELECT y, j, 2 + sum(length(j) + 2) OVER (PARTITION BY y ORDER BY k) - 2 - length(j) AS b, 2 + sum(length(j) + 2) OVER (PARTITION BY y ORDER BY k) - 2 AS e, floor((3 + sum(length(j) + 2) OVER (PARTITION BY y) - 1) * 0.75) AS cut FROM rows)
    WHERE e > cut) GROUP BY y"""))  # fmt: skip
def json_array_recovered(spark, sf):
    """Truncated arrays: what is left up to the last closing brace, unless that closes nothing of the array."""
    df = arrays.json_arrays(spark, _array_tree(spark, sf, 0.75), "k long", arrays.RECOVER, glob="*.txt")
    return df.select("k", F.regexp_extract("_file", r"y=(\d+)", 1).cast("long").alias("y"))


#: Rows in a CSV file that is written.
_CSV_ROWS = 50_000


@query("csv_tree_scan", duck("SELECT k, case_no, path, concat(z3, chr(10), z4) AS full_text FROM cases"))
def csv_tree_scan(spark, sf):
    """CSV files with line breaks in quotes, written and read back."""
    c = view(spark, sf, CASES).select(F.col("k").cast("string"), "case_no", "path", F.concat("z3", F.lit("\n"), "z4").alias("full_text"))
    path = scratch(spark, "csv-tree")
    # a file with quoted line breaks is one task's to read, so files are bounded by rows, not by their number
    c.write.option("maxRecordsPerFile", _CSV_ROWS).option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("nullValue", "∅").csv(path)
    df = readers.csv_tree(spark, path, ["k", "case_no", "path", "full_text"])
    return df.select(F.col("k").cast("long"), F.nullif("case_no", F.lit("∅")).alias("case_no"), "path", "full_text")


@query("jsonl_scan", duck("SELECT k, z3 FROM cases WHERE k % 9 <> 4 AND k % 9 <> 5"))
def jsonl_scan(spark, sf):
    """JSON lines, some broken, some blank: these are skipped."""
    lines = view(spark, sf, CASES).select(F.when(F.col("k") % 9 == 4, "{broken").when(F.col("k") % 9 == 5, "  ").otherwise(F.to_json(F.struct("k", "z3"))).alias("value"))
    path = scratch(spark, "jsonl-tree")
    lines.write.text(path)
    return readers.json_lines_splittable(spark, path, "k long, z3 string", glob="*.txt").select("k", "z3")


# --- months -----------------------------------------------------------------------------------------------------------

_MONTH = "regexp_extract(string_split(path, '/')[-1], '[0-9]{4}-[0-9]{2}')"
_PARTED = "list_filter(string_split(path, '/'), lambda p: p <> '')"
_FIRST = f"SELECT k, path, {_MONTH} AS m, {_PARTED} = min({_PARTED}) OVER (PARTITION BY {_MONTH}) AS first FROM cases"


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    c = view(spark, sf, CASES).select("k", "z4", F.col("path").alias("_file"), paths.year_month("path").alias("ym"))
    return c.select("k", "z4", "_file", "ym.year", "ym.year_month")


@query("months_skip_existing", duck("SELECT k, left(m, 4) AS year, m AS year_month, CAST(CASE WHEN CAST(right(m, 2) AS INT) <= 6 THEN 1 ELSE 2 END AS INT) AS run FROM first WHERE first", first=_FIRST))
def months_skip_existing(spark, sf):
    """Two runs, the first over half the months only: the second leaves these alone, and of a month's files the first counts."""
    df, path = _monthly(spark, sf), scratch(spark, "months")
    months.write(df.filter(F.substring("year_month", -2, 2).cast("int") <= 6), path, run="1")
    months.write(df, path, run="2")
    return months.read(spark, path, "k long, z4 string").select("k", "year", "year_month", F.col("run").cast("int").alias("run"))


@query("months_append_overwrite", duck("SELECT k, m AS year_month, n FROM (SELECT k, m, unnest(CASE WHEN m LIKE '%-01' THEN ['3'] ELSE ['1', '2'] END) AS n FROM first) WHERE n <> '2' OR k % 2 = 0", first=_FIRST))
def months_append_overwrite(spark, sf):
    """All rows, those of even k again, and Januaries replaced."""
    df, path = _monthly(spark, sf), scratch(spark, "months")
    months.write(df, path, months.APPEND, run="1")
    months.write(df.filter("k % 2 = 0"), path, months.APPEND, run="2")
    months.write(df.filter("year_month LIKE '%-01'"), path, months.OVERWRITE, run="3")
    return months.read(spark, path, "k long").select("k", "year_month", F.col("run").alias("n"))


@query("listed_months", duck("SELECT m AS year_month, count(*) > 0 AS has_files FROM first WHERE first AND m NOT LIKE '2012%' GROUP BY 1", first=_FIRST))
def listed_months(spark, sf):
    """The months of a stored tree by its files' names alone; one year's folder is excluded before the scan."""
    path = scratch(spark, "months")
    months.write(_monthly(spark, sf), path, run="1")
    found = files.listed(spark, path, "*.json", exclude=f"{path}/year=2012").filter("length > 0")
    return found.groupBy(F.regexp_extract("_file", r"year_month=([^/]+)", 1).alias("year_month")).agg((F.count(F.lit(1)) > 0).alias("has_files"))


# --- resuming ---------------------------------------------------------------------------------------------------------

_DONE = "trim(coalesce(case_no, ''))"


@query("resume_by_index", duck(f"SELECT k FROM cases WHERE {_DONE} = '' OR {_DONE} NOT IN (SELECT {_DONE} FROM cases WHERE (k % 3 = 0 OR k % 5 = 0) AND {_DONE} <> '')"))
def resume_by_index(spark, sf):
    """Two runs' finished keys in a bucketed index, which the third run's rows are joined with."""
    c, path = view(spark, sf, CASES).select("k", "case_no"), scratch(spark, "resume-index")
    index = ResumeIndex(spark, "judgex_" + path.rsplit("-", 1)[1], path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index.add(c.filter("k % 3 = 0"), "case")
    index.add(c.filter("k % 5 = 0"), "case")
    return index.remaining(c, "case").select("k")


@query("first_issues_by_law", duck("SELECT law, k, article, n FROM (SELECT law_name AS law, k, article, row_number() OVER (PARTITION BY law_name ORDER BY k, i) AS n FROM cited) WHERE n <= 3", cited=CITED))
def first_issues_by_law(spark, sf):
    """The first three citations of each law. The limit is the feature: a report shows a few examples of each kind."""
    df = resume.first_of_each(view(spark, sf, CITED), 3, ["law_name"], "k", "i")
    n = F.row_number().over(Window.partitionBy("law_name").orderBy("k", "i")).cast("long")
    return df.select(F.col("law_name").alias("law"), "k", "article", n.alias("n"))


@query("first_issues", duck("SELECT k, i, law_name FROM cited WHERE law_name = '' ORDER BY k, i LIMIT 10", cited=CITED))
def first_issues(spark, sf):
    """The first ten citations without a law, as an evaluation that stops there lists them."""
    return resume.first_rows(view(spark, sf, CITED).filter("law_name = ''"), 10, "k", "i").select("k", "i", "law_name")


# --- the boundary scorer ----------------------------------------------------------------------------------------------

#: Characters count as their code modulo 97, so a is padding.
_CHARS = "SELECT conv_id, turn, ascii(c) % 97 AS id FROM (SELECT conv_id, turn, unnest(string_split(text, '')) AS c FROM conversations) WHERE c <> '' AND ascii(c) % 97 <> 0"
_VECTORS = "SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings"
_HEADS = [scorer.Head([(7 * d + 13 * h) % 5 - 2 for d in range(64)], h) for h in range(3)]
_POOLED = f"""
WITH chars AS ({_CHARS}), vectors AS ({_VECTORS}), sums AS (
  SELECT conv_id, turn, d, sum(x) AS s FROM (SELECT conv_id, turn, unnest(range(1, 65)) AS d, unnest(v) AS x FROM chars LEFT JOIN vectors USING (id)) GROUP BY ALL
), counts AS (SELECT conv_id, turn, count(*) AS n FROM chars GROUP BY ALL
), pooled AS (
  SELECT c.conv_id, c.turn, coalesce(n, 0) AS n, list_transform(range(1, 65), lambda d: coalesce(m[d], 0) / greatest(coalesce(n, 1), 1)) AS v
  FROM conversations c LEFT JOIN counts USING (conv_id, turn) LEFT JOIN (SELECT conv_id, turn, map(list(d), list(CAST(s AS DOUBLE))) AS m FROM sums GROUP BY ALL) USING (conv_id, turn)
), scored AS (
  SELECT conv_id, turn, n, v, {", ".join(f"round({h.bias} + list_sum(list_transform(range(1, 65), lambda d: v[d] * ((7 * (d - 1) + 13 * {i}) % 5 - 2))), 6) AS h{i}" for i, h in enumerate(_HEADS))} FROM pooled
)
"""


def _pooled_turns(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    ids = F.transform(F.filter(F.split("text", ""), lambda c: c != ""), lambda c: F.ascii(c) % 97)
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("v"))
    return scorer.pooled(turns.select("conv_id", "turn", ids.alias("ids")), vectors, 64, ["conv_id", "turn"])


@query("masked_mean_pool", _POOLED + "SELECT conv_id, turn, n, v[1] AS first, v[64] AS last, h0, h1, h2 FROM scored")
def masked_mean_pool(spark, sf):
    p = _pooled_turns(spark, sf)
    return p.select("conv_id", "turn", "n", F.col("v")[0].alias("first"), F.col("v")[63].alias("last"), *(F.round(scorer.score("v", h), 6).alias(f"h{i}") for i, h in enumerate(_HEADS)))


@query("masked_argmax", _POOLED + "SELECT conv_id, " + ", ".join(f"CAST(arg_min(turn, ((role <> 'user')::INT, CASE WHEN role = 'user' THEN -h{i} ELSE 0 END, turn)) AS BIGINT) AS pick{i}" for i in range(3)) + " FROM scored JOIN (SELECT conv_id, turn, role FROM conversations) USING (conv_id, turn) GROUP BY conv_id")
def masked_argmax(spark, sf):
    """For each head the turn of a user that scores highest in its conversation."""
    roles = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role")
    rows = _pooled_turns(spark, sf).join(roles, ["conv_id", "turn"])
    p = scorer.picked(rows, ["conv_id"], "turn", [F.round(scorer.score("v", h), 6) for h in _HEADS], F.col("role") == "user")
    return p.select("conv_id", *(F.col("picks")[i].alias(f"pick{i}") for i in range(3)))


# --- records ----------------------------------------------------------------------------------------------------------


@query("partition_passthrough", duck("SELECT concat('s', cast(k AS STRING)) AS sample_id, case_no, CAST(length(full_text) AS INT) AS text_length, CAST(strpos(full_text, '号') AS INT) AS z1_end FROM cases"))
def partition_passthrough(spark, sf):
    """Partitions of whole records: the fields that are passed on, and the text from whichever column is filled."""
    c = view(spark, sf, CASES).select(F.format_string("s%d", "k").alias("sample_id"), "case_no", F.when(F.col("k") % 2 == 0, F.col("full_text")).otherwise("").alias("text"), F.when(F.col("k") % 2 == 1, F.col("full_text")).alias("full_text"), "z3")
    p = zones.partition_records(c)
    return p.select("sample_id", "case_no", "text_length", F.col("anchor_end.Z1_Header").alias("z1_end"))
