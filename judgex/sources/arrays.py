"""JSON arrays in files of any size, read in byte ranges: no task holds a file.

Files are read as pieces that end at closing braces, which Spark's text source cuts in splits as it cuts lines. Whether a piece begins inside
a string and how deep it begins follow from counts of quotes and brackets in the pieces before, summed within a split first and over
a file's splits then. An element ends where a brace closes at the depth of the array; its pieces are put together in their split, and only elements that
lie across a split's edge meet again. What is known of a file or a split is a row each and goes to the pieces, so pieces never gather by file.

Rows carry ``_file``, ``_pos`` (which object of the array, from 0) and ``_json``. Values between objects that are no objects are left out.

Modes, file by file: ``strict`` files must be whole arrays, others give no rows. ``recover`` takes files as if cut after their last closing brace, with missing
brackets added; where that leaves no array (the brace closes something inside an element), they give none. ``salvage`` keeps every whole
element, whatever comes after. An element must parse, or in the first two modes its file gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from judgex.functions.pytext import SPACE, let, strip
from judgex.operators.resume import FILE, POS
from judgex.session import cut

STRICT, RECOVER, SALVAGE = "strict", "recover", "salvage"
_SPLIT = [FILE, "_block"]


def _pieces(spark: SparkSession, path: str, glob: str, exclude: str | None) -> DataFrame:
    """Rows (_file, _block, _n, _size, _piece): text up to a closing brace; pieces of a split are in the order of _n."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "}").text(path)
    m = "_metadata"
    df = df.select(F.col(f"{m}.file_path").alias(FILE), F.col(f"{m}.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n"), F.col(f"{m}.file_size").alias("_size"), F.col("value").alias("_piece"))
    return df.filter(~F.contains(FILE, F.lit("/" + exclude.strip("/") + "/"))) if exclude else df


def _outside(plain: Column, inside: Column) -> Column:
    """The text that isn't in strings, of a piece without escapes that begins inside a string or not."""
    return F.array_join(F.filter(F.split(plain, '"'), lambda _, i: i % 2 == inside), "")


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def _before(value: Column | str, by: list[str], order: str) -> Column:
    """The sum of what comes before."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def _over_splits(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over all pieces of the file before: within the split, and over the splits before."""
    each = rows.groupBy(*_SPLIT).agg(F.sum(value).alias("_all"))
    base = each.select(*_SPLIT, _before("_all", [FILE], "_block").alias("_base"))  # a row a split
    here = rows.withColumn(name, _before(value, _SPLIT, "_n"))
    return here.join(F.broadcast(base), _SPLIT).withColumn(name, F.col(name) + F.col("_base")).drop("_base")


def _measured(pieces: DataFrame) -> DataFrame:
    """Pieces with _deep, the depth after each, and _ends: 1 where an element of the array ends."""
    # what a piece says by itself, whether it begins inside a string or not, is read off its text once and written
    change = lambda inside: lambda plain: let(_outside(plain, F.lit(inside)), lambda o: _count(o, "{[") - _count(o, "]"))
    said = lambda plain: F.struct(_count(plain, '"').alias("_quotes"), change(0)(plain).alias("_o0"), change(1)(plain).alias("_o1"))
    plain = F.when(F.contains("_piece", F.lit("\\")), F.regexp_replace("_piece", r"(?s)\\.", "")).otherwise(F.col("_piece"))
    pieces = cut(pieces.withColumn("_said", let(plain, said)).select("*", "_said.*").drop("_said"), "json-read")
    rows = pieces
    # whether a brace follows is known for all pieces but a file's last: there it shows in the file's size
    last = pieces.groupBy(FILE).agg(F.max(F.struct("_block", "_n")).alias("_last"), (F.sum(F.octet_length("_piece") + 1) == F.max("_size")).alias("_closed"))
    rows = rows.join(F.broadcast(last), FILE).withColumn("_brace", ((F.struct("_block", "_n") != F.col("_last")) | F.col("_closed")).cast("int")).drop("_last", "_closed")
    rows = _over_splits(rows, "_quotes", "_quoted")
    rows = rows.withColumn("_o", F.when(F.col("_quoted") % 2 == 0, F.col("_o0")).otherwise(F.col("_o1"))).drop("_o0", "_o1")
    real = (F.col("_brace") == 1) & ((F.col("_quoted") + F.col("_quotes")) % 2 == 0)
    rows = rows.withColumn("_real", real.cast("int")).withColumn("_change", F.col("_o") - F.col("_real"))
    rows = _over_splits(rows, "_change", "_deep").withColumn("_deep", F.col("_deep") + F.col("_change"))
    # a file that doesn't begin with a bracket is read as if it did
    head = F.regexp_replace(F.min_by("_piece", F.struct("_block", "_n")), rf"\A\ufeff?[{SPACE}]*", "")
    rows = rows.join(F.broadcast(pieces.groupBy(FILE).agg((~head.startswith("[")).alias("_bare"))), FILE).withColumn("_deep", F.col("_deep") + F.col("_bare").cast("int"))
    return rows.withColumn("_ends", ((F.col("_real") == 1) & (F.col("_deep") == 1)).cast("int"))


def _groups(rows: DataFrame) -> DataFrame:
    """Rows (_file, _pos, _whole, _text): the text of each element with what stands before it, and of the rest of a file."""
    rows = _over_splits(rows, "_ends", POS)
    text = F.concat("_piece", F.when(F.col("_brace") == 1, "}").otherwise(""))
    first = rows.groupBy(*_SPLIT).agg(F.min(POS).alias("_first"))
    own = rows.groupBy(*_SPLIT, POS).agg(F.max("_ends").alias("_whole"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", text.alias("t")))), lambda p: p["t"]), "").alias("_text"), F.max("_bare").alias("_bare"))
    own = own.join(F.broadcast(first), _SPLIT)
    inner = (F.col("_whole") == 1) & (F.col(POS) > F.col("_first"))  # begun and ended in its split
    edge = own.filter(~inner).groupBy(FILE, POS).agg(F.max("_whole").alias("_whole"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_text"))), lambda p: p["_text"]), "").alias("_text"), F.max("_bare").alias("_bare"))
    return own.filter(inner).select(FILE, POS, "_whole", "_text", "_bare").unionByName(edge)


def _parsed(groups: DataFrame) -> DataFrame:
    """With _json, an element's own text, and _good: whether the group fits into an array where it stands."""
    text = strip(F.regexp_replace("_text", r"\A\ufeff", ""))
    # before an element stands the array's opening bracket or, later, a comma
    begun = F.when(F.col(POS) > 0, F.concat(F.lit("[0"), text)).when(F.col("_bare"), F.concat(F.lit("["), text)).otherwise(text)
    g = groups.withColumn("_closed", F.when(F.col("_whole") == 1, F.concat(begun, F.lit("]"))).otherwise(begun))
    # text after the bracket that closes the array doesn't keep Spark from reading it
    good = F.try_parse_json("_closed").isNotNull() & F.col("_closed").startswith("[") & F.col("_closed").endswith("]")
    g = g.withColumn("_good", F.coalesce(good, F.lit(False)))
    short = F.regexp_replace(text, rf"\A[\[,][{SPACE}]*", "")
    item = F.when(short.startswith("{"), short).otherwise(F.try_element_at(F.from_json("_closed", "array<string>"), F.lit(-1)))
    item = F.when((F.col("_whole") == 1) & F.try_parse_json(item).isNotNull() & item.startswith("{"), item)
    return g.withColumn("_json", item).withColumn("_blank", text == "").drop("_closed", "_text")


def _files(measured: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (_file, strict, recover): the modes in which a file gives rows."""
    last = F.struct("_block", "_n")
    ends = measured.groupBy(FILE).agg(
        (F.max_by("_deep", last) == 0).alias("balanced"), (F.max_by(F.col("_quoted") + F.col("_quotes"), last) % 2 == 0).alias("even"), (F.max_by(F.when(F.col("_brace") == 1, F.col("_ends")), F.when(F.col("_brace") == 1, last)) == 1).alias("closes")
    )
    each = groups.groupBy(FILE).agg(
        F.min("_good").alias("all_fit"), F.min(F.when(F.col("_whole") == 1, F.col("_good"))).alias("objects_fit"), F.max("_bare").alias("bare"), F.sum("_whole").alias("objects"), F.max((F.col("_whole") == 0) & ~F.col("_blank")).alias("more")
    )
    strict = F.col("all_fit") & ~F.col("bare") & F.col("balanced") & F.col("even")
    one_object = F.col("bare") & (F.col("objects") == 1) & ~F.col("more")  # that is whole as it is, and no array
    recover = strict | (F.coalesce(F.col("closes"), F.lit(False)) & F.coalesce(F.col("objects_fit"), F.lit(False)) & ~one_object)
    return ends.join(each, FILE).select(FILE, strict.alias(STRICT), recover.alias(RECOVER))


def json_array_elements(spark: SparkSession, path: str, mode: str = STRICT, glob: str = "*.json", exclude: str | None = None) -> DataFrame:
    """Rows (_file, _pos, _json) of the objects in the arrays of a tree's files, by ``mode``."""
    measured = cut(_measured(_pieces(spark, path, glob, exclude)), "json-pieces")
    groups = cut(_parsed(_groups(measured)), "json-elements")
    found = groups.filter("_whole = 1 AND _json IS NOT NULL").select(FILE, POS, "_json")
    if mode == SALVAGE:
        return found
    return found.join(F.broadcast(_files(measured, groups).filter(mode).select(FILE)), FILE, "left_semi")


def json_arrays(spark: SparkSession, path: str, schema: str, mode: str = STRICT, glob: str = "*.json", exclude: str | None = None) -> DataFrame:
    """The objects as columns of ``schema``, with ``_file``, ``_pos`` and ``_json``."""
    rows = json_array_elements(spark, path, mode, glob, exclude)
    return rows.select(FILE, POS, "_json", F.from_json("_json", schema).alias("_r")).select("_r.*", FILE, POS, "_json")
