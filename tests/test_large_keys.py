"""Queries over keys larger than those of the test tables, against their SQL in DuckDB."""

import duckdb
import pytest

from sieveline.queries import ORACLES, QUERIES

KEYS = [0, 1, 6007, 149_999, 899_999, 8_999_999, *range(5_000_000, 5_000_300)]


@pytest.mark.parametrize("name", ["checksum_abn", "checksum_acn", "checksum_medicare", "checksum_tfn"])
def test_numbers_longer_than_the_identifier(spark, tmp_path, name):
    """Numbers that outgrow the identifier lose their last digits."""
    spark.createDataFrame([(k,) for k in KEYS], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    want = duckdb.execute(f"WITH orders AS (SELECT * FROM '{tmp_path}/orders.parquet/*.parquet') SELECT o_orderkey, value, ok FROM ({ORACLES[name]})").fetchall()
    got = [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select("o_orderkey", "value", "ok").collect()]
    assert sorted(got) == sorted(want) and {ok for _, _, ok in want} == {True, False}
