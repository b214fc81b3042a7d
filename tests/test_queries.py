"""Every core query against its DuckDB equivalent, or else its own invariants."""

import pytest

from judgex.plans import queries as core

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_matches_sql(name, same):
    same(core.QUERIES[name], core.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_runs(name, spark):
    df = core.QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_funnel_adds_up(spark):
    r = core.QUERIES["sft_amount_funnel"](spark, SF).first()
    assert r.total == r.valid + r.missing + r.ambiguous + r.invalid + r.overlength + r.duplicate


def test_sample_does_not_depend_on_partitions(spark):
    from judgex.operators.resume import seeded_sample

    df = spark.range(1000).toDF("k")
    a = [r.k for r in seeded_sample(df.repartition(3), 20, 7, "k").collect()]
    assert a == [r.k for r in seeded_sample(df.repartition(11), 20, 7, "k").collect()]
    assert a != [r.k for r in seeded_sample(df, 20, 8, "k").collect()]


def test_numerals_of_all_customers(spark):
    assert core.QUERIES["cn_numerals_all"](spark, SF).count() == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_list_repr_of_whole_texts(spark):
    texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    assert {(r.conv_id, r.turn): r.r for r in core.QUERIES["list_repr_whole"](spark, SF).collect()} == {k: repr([t, "x"]) for k, t in texts.items()}
