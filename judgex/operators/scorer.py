"""A boundary scorer made of joins and aggregates: masked mean pooling of character vectors, linear heads, masked argmax.

A sentence's vector is the mean of its characters' vectors, padding left out. Counts of characters come first, so a sentence
joins each vector once; vectors are a table of (id, v), sums are map-side combined aggregates with one column a dimension. A head scores a
sentence by a dot product; in every record it picks the sentence of the highest score among those that count, the first of equal ones. A
recurrent encoder between the two is left to plug-ins; without it this is a scorer over bags of characters.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgex.functions import zones
from judgex.functions.pytext import SPACE


class Head(NamedTuple):
    weights: Sequence[float]
    bias: float = 0.0


def pooled(sentences: DataFrame, vectors: DataFrame, dim: int, by: Sequence[str], pad: int = 0, ids: str = "ids") -> DataFrame:
    """Rows (*by, n, v): characters that aren't padding, and the mean of their vectors; zeros where there are none.

    ``sentences`` has one row a key. Ids without a vector count as zeros.
    """
    counts = sentences.select(*by, F.explode(ids).alias("id")).filter(F.col("id") != pad).groupBy(*by, "id").agg(F.count(F.lit(1)).alias("c"))
    met = counts.join(vectors.select("id", F.col("v").alias("_v")), "id", "left")
    sums = met.groupBy(*by).agg(F.sum("c").alias("n"), *(F.sum(F.get("_v", F.lit(d)) * F.col("c")).alias(f"_s{d}") for d in range(dim)))
    mean = F.array(*(F.coalesce(F.col(f"_s{d}").cast("double"), F.lit(0.0)) / F.greatest(F.coalesce("n", F.lit(1)), F.lit(1)) for d in range(dim)))
    return sentences.select(*by).join(sums, list(by), "left").select(*by, F.coalesce("n", F.lit(0)).cast("long").alias("n"), mean.alias("v"))


def score(v: Column | str, head: Head) -> Column:
    """A head's score of a vector."""
    x = F.col(v) if isinstance(v, str) else v
    weights = F.array(*(F.lit(float(w)) for w in head.weights))
    return F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(float(head.bias)), lambda s, p: s + p)


def picked(scored: DataFrame, by: Sequence[str], at: str, heads: Sequence[Column], mask: Column | None = None) -> DataFrame:
    """Rows (*by, picks): for each head the place ``at`` of the highest score where ``mask`` holds; the first place where it holds nowhere."""
    on = F.lit(True) if mask is None else F.coalesce(mask, F.lit(False))
    best = [F.max_by(at, F.struct(on, F.when(on, h).alias("score"), -F.col(at))) for h in heads]
    return scored.groupBy(*by).agg(F.array(*best).alias("picks"))


def boundaries(texts: DataFrame, vocabulary: DataFrame, vectors: DataFrame, dim: int, heads: Sequence[Head], by: str = "k", text: str = "text", pad: int = 0, unknown: int = 1) -> DataFrame:
    """Rows (by, boundaries): the ends of the sentences that the heads pick in each text, made to rise; empty for empty texts.

    ``vocabulary`` has (char, id). Sentences are sampled down and cut as models expect them (``zones``); a sentence without visible characters has the unknown id.
    """
    cuts = zones.downsample(zones.slices(zones.boundaries(text)))
    each = texts.select(by, text, F.posexplode(cuts).alias("i", "s")).select(by, "i", F.col("s.end").alias("end"), F.substring(text, F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("sentence"))
    visible = F.slice(F.filter(F.split("sentence", ""), lambda c: ~c.rlike(f"\\A[{SPACE}]*\\z")), 1, zones.MAX_CHARS)
    chars = each.select(by, "i", F.explode_outer(visible).alias("char")).groupBy(by, "i", "char").agg(F.count(F.lit(1)).alias("c"))
    known = chars.join(vocabulary.select("char", "id"), "char", "left").select(by, "i", F.coalesce("id", F.lit(unknown)).alias("id"), "c")
    ids = known.groupBy(by, "i").agg(F.flatten(F.collect_list(F.array_repeat("id", F.col("c").cast("int")))).alias("ids"))  # of one sentence
    scored = pooled(ids, vectors, dim, [by, "i"], pad).join(each.select(by, "i", "end"), [by, "i"])
    ends = scored.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("i", "end"))).alias("_ends"))  # of one text, at most zones.MAX_SENTENCES
    picks = picked(scored, [by], "i", [score("v", h) for h in heads]).join(ends, by)
    chosen = F.transform("picks", lambda i: F.try_element_at("_ends", i))
    out = texts.select(by, text).join(picks.select(by, chosen.alias("_b")), by, "left")
    return out.select(by, zones.monotonic(F.coalesce("_b", F.array()), F.length(F.coalesce(text, F.lit("")))).alias("boundaries"))
