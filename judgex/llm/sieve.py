"""A sieve of ids: a bit table of bounded size that lets all ids of a set through and few others.

Joins that need the texts of some documents would move every text. The sieve is a table of at most ``WORDS`` rows (word, bits), so it can
be broadcast whatever the size of the set; rows that it stops certainly aren't in the set, and only those it lets through
go on to the exact join. About one in sixteen others gets through; beyond 16 * WORDS ids more do, and the exact join still decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the broadcast table: a million rows of two integers.
WORDS = 1 << 20


def _place(uid: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(uid, F.lit(7))
    return F.pmod(h, F.lit(words)).cast("int"), F.shiftrightunsigned(h, 58).cast("int")


def _table(ids: DataFrame) -> tuple[DataFrame, int]:
    words = min(WORDS, 1 + ids.count() // 4)
    word, bit = _place(F.col(ids.columns[0]), words)
    return ids.select(word.alias("__w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy("__w").agg(F.bit_or("b").alias("__bits")), words


def marked(df: DataFrame, uid: Column, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false where ``uid`` certainly isn't among ``ids`` (one column), or is null."""
    sieve, words = _table(ids)
    word, bit = _place(uid, words)
    hit = F.coalesce(F.call_function("shiftright", F.col("__bits"), bit).bitwiseAND(1) == 1, F.lit(False)) & uid.isNotNull()
    return df.withColumn("__at", word).join(F.broadcast(sieve), F.col("__at") == F.col("__w"), "left").withColumn(name, hit).drop("__at", "__w", "__bits")


def sifted(df: DataFrame, uid: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``uid`` may be among ``ids``, and few others."""
    return marked(df, F.col(uid), ids, "__hit").filter("__hit").drop("__hit")
