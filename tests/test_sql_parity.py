"""Every named query against its independent SQL form in DuckDB (sf0.01)."""

import os

import duckdb
import pytest

from pitboss.catalog.registry import load_all
from pitboss.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.01"

import sys  # noqa: E402
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_sql import digest  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402

NAMES = sorted(load_all())
SCHEMAS = {}   # of the queries that test_parity has built


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(NAMES) <= set(oracle_sql()) and set(NAMES) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_parity(spark, con, name):
    df = queries()[name](spark, SF)
    SCHEMAS[name] = df.schema
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 41


def _duck_type(dt) -> str:
    from pyspark.sql import types as T
    simple = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT", T.StringType: "VARCHAR",
              T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
              T.BooleanType: "BOOLEAN", T.DoubleType: "DOUBLE"}
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return simple.get(type(dt), str(dt))


def test_column_types_agree(spark, con):
    """Same column types on both sides (no INT vs BIGINT, no decimal scale drift)."""
    q, o = queries(), oracle_sql()
    bad = {}
    for name in NAMES:
        sp = {f.name: _duck_type(f.dataType) for f in (SCHEMAS.get(name) or q[name](spark, SF).schema).fields}
        rel = con.sql(f"SELECT * FROM ({o[name]}) LIMIT 0")
        dk = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (sp[c], dk.get(c)) for c in sp if sp[c] != dk.get(c)}
        if diff:
            bad[name] = diff
    assert bad == {}
