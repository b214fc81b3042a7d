"""Year and month from file paths, by the four rules of the annotation runs; relative paths and path order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from judgex.functions.pytext import col


def parts(path: Column | str) -> Column:
    """Path components. Paths are ordered by these, not by the text."""
    return F.filter(F.split(F.replace(col(path), F.lit("\\"), F.lit("/")), "/"), lambda p: p != "")


def stem(path: Column | str) -> Column:
    return F.regexp_replace(F.element_at(parts(path), -1), r"(?<=.)\.[^.]+\z", "")


def _parent(path: Column | str) -> Column:
    return F.coalesce(F.try_element_at(parts(path), F.lit(-2)), F.lit(""))


def year_month(path: Column | str) -> Column:
    """struct<year, year_month>: the first dddd-dd in the stem; else a four-digit parent (or unknown) and the stem."""
    s = stem(path)
    dated = s.rlike(r"\d{4}-\d{2}")
    year = F.when(dated, F.regexp_extract(s, r"(\d{4})-(\d{2})", 1)).when(_parent(path).rlike(r"\A\d{4}\z"), _parent(path)).otherwise("unknown")
    return F.struct(year.alias("year"), F.when(dated, F.regexp_extract(s, r"\d{4}-\d{2}", 0)).otherwise(s).alias("year_month"))


def year_month_of_stem(path: Column | str) -> Column:
    """struct<year, year_month>: of a stem that has - and digits before it; else unknown and the stem."""
    p = F.split(stem(path), "-")
    ok = (F.size(p) >= 2) & F.get(p, F.lit(0)).rlike(r"\A\d+\z")
    return F.struct(F.when(ok, F.get(p, F.lit(0))).otherwise("unknown").alias("year"), F.when(ok, F.concat_ws("-", F.get(p, F.lit(0)), F.get(p, F.lit(1)))).otherwise(stem(path)).alias("year_month"))


def year_of_output(path: Column | str) -> Column:
    """The stem's first four digits; else the deepest four-digit component; else unknown_year."""
    s = stem(path)
    deep = F.get(F.filter(F.reverse(parts(path)), lambda p: p.rlike(r"\A\d{4}\z")), F.lit(0))
    return F.when(s.rlike(r"\A\d{4}"), F.substring(s, 1, 4)).otherwise(F.coalesce(deep, F.lit("unknown_year")))


def year_of_parent(path: Column | str) -> Column:
    """The parent folder's name as it is."""
    return _parent(path)


def relative(path: Column | str, root: str) -> Column:
    """The path below a root; unchanged if it is elsewhere."""
    base = root.rstrip("/") + "/"
    return F.when(F.startswith(col(path), F.lit(base)), F.substring(col(path), len(base) + 1, 1 << 30)).otherwise(col(path))


def output_path(path: Column | str, root: str) -> Column:
    """The path below a root without a leading input_data/, as .json."""
    return F.concat(F.regexp_replace(F.regexp_replace(relative(path, root), r"\Ainput_data/", ""), r"\.[^./]+\z", ""), F.lit(".json"))
