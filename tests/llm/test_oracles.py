"""Operators with check SQL give the same rows as DuckDB."""

import duckdb
import pytest

from orderlens.llm import queries

from ..oracle_check import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_same_rows(spark, key):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert compare(queries.QUERIES[key](spark, SF_DIR), con, queries.ORACLES[key]) is None
