"""Text queries against their SQL forms in DuckDB (sf0.01)."""

import os
import sys

import duckdb
import pytest

from pitboss.llm.queries import QUERIES, SQL

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
from check_sql import digest  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = QUERIES[name](spark, SF)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, result.fetchall())[0]
