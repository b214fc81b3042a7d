"""The sieve lets every id of its set through, and few others."""

import pytest
from pyspark.sql import functions as F

from judgex.llm import sieve


@pytest.mark.parametrize("n", [0, 1, 700])
def test_no_id_is_lost(spark, n):
    ids = spark.range(n).select((F.col("id") * 7919 - 3000).alias("u"))
    rows = spark.range(-5000, 5000).select(F.col("id").alias("uid")).unionAll(spark.createDataFrame([(None,)], "uid long")).unionAll(ids)
    through = {r.uid for r in sieve.sifted(rows, "uid", ids).collect()}
    want = {i * 7919 - 3000 for i in range(n)}
    assert want <= through and None not in through and len(through - want) < 10_000 / 5
    flags = sieve.marked(rows, F.col("uid"), ids, "hit")
    assert flags.count() == rows.count() and flags.columns == ["uid", "hit"] and flags.filter("hit is null").count() == 0


def test_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(sieve, "WORDS", 4)
    ids = spark.range(5000).toDF("u")
    table, words = sieve._table(ids)
    assert words == 4 and table.count() <= 4 and sieve.sifted(ids, "u", ids).count() == 5000
