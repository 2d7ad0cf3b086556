"""Declared grains and references, checked (Spark enforces no constraints).

All checks are aggregations or anti-joins; only the violation counts (one
small row) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or contain NULL: ``(keys..., copies)``."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    has_null = None
    for k in keys:
        c = F.col(k).isNull()
        has_null = c if has_null is None else (has_null | c)
    return g.filter((F.col("copies") > 1) | has_null)


def assert_key(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Raise if ``keys`` is not a NOT NULL unique key of ``df`` (one count action)."""
    bad = key_violations(df, keys).agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    if bad:
        raise ValueError(f"{name}: {bad} key value(s) of {list(keys)} are duplicated or NULL")


def assert_not_null(df: DataFrame, columns: Sequence[str], name: str = "table") -> None:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).collect()[0]
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise ValueError(f"{name}: NULL values in NOT NULL columns {bad}")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: Sequence[str], dim_key: Sequence[str] | None = None) -> DataFrame:
    """Fact rows whose reference has no dimension row (C12): a left anti-join."""
    dk = list(dim_key or fact_key)
    d = dim.select(*[F.col(a).alias(b) for a, b in zip(dk, fact_key)])
    return fact.join(d, list(fact_key), "left_anti")


def reference_check(fact: DataFrame, dim: DataFrame, fact_key: Sequence[str],
                    dim_key: Sequence[str] | None = None) -> DataFrame:
    """One row: fact rows and orphan rows of a reference."""
    o = orphans(fact, dim, fact_key, dim_key).agg(F.count(F.lit(1)).alias("orphan_rows"))
    n = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    # two one-row aggregates stacked and folded into one row (no join needed)
    return n.unionByName(o, allowMissingColumns=True).agg(F.max("fact_rows").alias("fact_rows"),
                                                           F.max("orphan_rows").alias("orphan_rows"))
