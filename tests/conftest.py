import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from judgex.session import local_session

    s = local_session(**{"spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(_norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="session")
def same(spark, duck):
    """Compare a query with its SQL: names, rows and values."""

    def check(f, sql):
        df = f(spark, SF)
        cols = sorted(df.columns)
        got = sorted(repr([_norm(r[c]) for c in cols]) for r in df.collect())
        res = duck.execute(sql)
        names = [c[0] for c in res.description]
        assert sorted(names) == cols
        want = sorted(repr([_norm(r[names.index(c)]) for c in cols]) for r in res.fetchall())
        assert got == want

    return check
