"""Queries with SQL against DuckDB over whole tables; every operator has a query."""

import duckdb
import pytest

from riskloom.llm.oracle import all_oracles
from riskloom.llm.queries import all_queries

SF = "/root/testdata/sf0.001"


def test_a_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in all_queries()) == list(range(1, 14))
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("key", sorted(all_oracles()))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = all_queries()[key](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({all_oracles()[key]})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))
