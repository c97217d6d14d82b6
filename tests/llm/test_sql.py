"""Operators that SQL can express, next to their SQL in DuckDB."""

import duckdb
import pytest

from tarn.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))
