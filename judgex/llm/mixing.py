"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Every source has a weight schedule over training time 0..1. Its integral is the source's weight;
weights and a repeat limit give each source a target of words. The schedule's running integral,
scaled to the target, is the source's cumulative demand for words; a document whose words end at
some cumulative amount is due at the time at which the demand reaches it, so inverting the demand gives
its training position. Documents are range-sorted by position.

A source's documents come in the order of md5(doc_id); each pass over the source takes them all, and the last,
partial pass takes documents up to the target, the last of them by its first words only. Running sums never
put a source in one task: rows are cut into about sqrt(n) md5 ranges, summed on their own, and shifted by the
ranges before them.

Defined results: null or wordless text has size 0 and takes 0 words, at no position; null sources are a
source, ordered last; rows with null or repeated doc_id each count, in an order by doc_id, size and text hash; an
empty table gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from judgex.session import cut

WORD = r"[^\x20\x09-\x0D]+"
#: (time, weight) knots of the three schedules, dealt to sources in turn. Their integrals are 5, 2 and 1: a source that
#: fades out, one that stays, and one that fades in.
SCHEDULES = (((0.0, 8.0), (1.0, 2.0)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)))


def integral(knots: Sequence[tuple[float, float]]) -> float:
    """The area under a piecewise linear schedule."""
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def _time_at(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which a schedule's running integral is ``share`` of the whole."""
    total, done, out = integral(knots), 0.0, None
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        if area <= 0:
            continue
        rest, slope = share * F.lit(total) - F.lit(done), (w1 - w0) / (t1 - t0)
        rest = F.greatest(F.lit(0.0), F.least(F.lit(area), rest))
        # w0 x + slope x^2 / 2 = rest, in the form that stays exact where the slope is small or w0 is 0
        x = F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(w0) + F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + 2 * slope * rest))))
        at = F.least(F.lit(t1), F.lit(t0) + x)
        out = at if out is None else F.when(share * F.lit(total) > F.lit(done), at).otherwise(out)
        done += area
    return out


def _sources(sized: DataFrame, weights: Sequence[float], share: float, max_repeat: int) -> DataFrame:
    """One row a source: size, schedule number, target.

    Targets fill up like water: target = min(limit, weight * level), where one level makes them sum to the budget. The
    level follows from the sources in order of limit / weight; it is the fixed point of resharing excess by weight.
    """
    by_code_point = F.col("source").asc_nulls_last()
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    s = s.withColumn("k", (F.row_number().over(Window.orderBy(by_code_point)) - 1) % len(weights))
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("k").cast("int") + 1))
    s = s.withColumn("cap", F.col("source_size") * max_repeat)
    fill = Window.orderBy(F.col("cap") / F.col("w"), by_code_point).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share) if share != 1 else F.sum("source_size").over(everything))
    s = s.withColumn("cap_before", F.coalesce(F.sum("cap").over(fill), F.lit(0))).withColumn("w_before", F.coalesce(F.sum("w").over(fill), F.lit(0)))
    s = s.withColumn("w_left", F.sum("w").over(everything) - F.col("w_before"))
    s = s.withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("w_left"))
    # the level is the first at which the next source isn't filled to its limit
    s = s.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("cap_before", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull() | (F.col("w") * F.col("level") > F.col("cap")), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("level"))
    return s.select("source", "source_size", "rows", "k", target.alias("target"))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = 1.0,
    max_repeat: int = 3,
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken, positions), range-sorted by first position.

    ``schedules`` are dealt in turn to the sources in code point order. ``positions`` has a training time for
    each time that the mix takes the document.
    """
    weights = [int(w) if (w := integral(k)) == int(w) else w for k in schedules]
    text = F.col("text")
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text).alias("tie"))
    sized = cut(sized.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "mix-sizes")
    sources = cut(_sources(sized, weights, share, max_repeat), "mix-sources")

    rows = sized.alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source")).select("doc_id", F.col("d.source").alias("source"), "size", "tie", "h", "source_size", "rows", "k", "target")
    ranges = F.greatest(F.lit(1), (F.sqrt("rows") / 10).cast("long"))
    rows = rows.withColumn("part", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * ranges / F.lit(float(1 << 32))))
    key = F.coalesce(F.xxhash64("source"), F.lit(0))
    rows = rows.withColumn("skey", key)
    sums = rows.groupBy("skey", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("skey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("skey", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("skey", "part").orderBy("h", F.col("doc_id").asc_nulls_first(), "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("here", F.sum("size").over(order)).join(sums, ["skey", "part"])

    start = F.col("base") + F.col("here") - F.col("size")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - passes * F.col("source_size") + 0.5).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    rows = rows.withColumns({"start": start, "passes": passes, "part": part})
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.col("passes") + (F.col("part") > 0).cast("long")).otherwise(F.lit(0)).cast("int"))
    middle = F.col("start") + F.col("size") / 2
    due = lambda i: F.least(F.lit(1.0), ((i - 1) * F.col("source_size") + middle) / F.col("target"))
    times = lambda knots: F.transform(F.sequence(F.lit(1), F.col("copies")), lambda i: _time_at(due(i), knots))
    when = F.coalesce(*(F.when(F.col("k") == i, times(knots)) for i, knots in enumerate(schedules)))
    rows = rows.withColumn("positions", F.when(F.col("copies") > 0, when).otherwise(F.array().cast("array<double>")))
    out = rows.select("doc_id", "source", "size", "source_size", "target", (F.col("passes") * F.col("size") + F.col("part")).alias("taken"), "positions", "h")
    # documents that are never due come last, spread by their hash
    at = F.coalesce(F.get("positions", F.lit(0)), 1 + F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)))
    return out.withColumn("at", at).repartitionByRange("at", "h").sortWithinPartitions("at", "h").drop("at", "h")


def schedule(mixed: DataFrame) -> DataFrame:
    """Rows (position, doc_id, source, pass): one for each time a document is due, range-sorted by position."""
    every = mixed.select("doc_id", "source", F.posexplode("positions").alias("pass", "position"))
    return every.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, 3 * source_size AS cap,
         coalesce(sum(3 * source_size) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before,
         sum(source_size) OVER () AS budget, sum(w) OVER () AS w_all
  FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, CAST(budget - cap_before AS DOUBLE) / CAST(w_all - w_before AS DOUBLE) AS level0 FROM f
), t AS (
  SELECT source, source_size, cap, w, (SELECT arg_min(level0, cap_before) FROM l WHERE level0 * w <= cap) AS level FROM l
), g AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR w * level > cap THEN CAST(cap AS DOUBLE) ELSE w * level END AS target FROM t
), r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start,
         CASE WHEN g.source_size = 0 THEN 0 ELSE floor(g.target / g.source_size) END AS passes
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(passes * size + greatest(0, least(size, floor(target - passes * source_size + 0.5) - start)) AS BIGINT) AS taken
FROM r
"""
