"""Every query with SQL gives the same rows in Spark and in DuckDB, on the smallest tables."""

import duckdb
import pytest

from sieveline.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(tuple(map(plain, r)) for r in got.select(*columns).collect())
    assert rows == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0
