"""Queries that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from fundlake.llm.registry import ORACLES, QUERIES

SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    found = con.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    df = QUERIES[name](spark, SF01)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, found.fetchall()))
