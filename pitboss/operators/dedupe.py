"""Keyed "last row wins" selection: upserts, DISTINCT ON, latest-per-key.

``latest_per_key`` is an aggregation, not a window: ``max(struct(order...,
payload...))`` per key.  Aggregations combine map-side, so a key that holds
a third of all rows (a large group of copies) is reduced inside every task
before the shuffle, and the shuffle carries one row per key and task.
The struct puts the order columns first and the payload after them, so ties
on the order are broken by the payload itself: the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_columns(df: DataFrame, keys: Sequence[str | Column]) -> list[Column]:
    """Key parts as columns: a column's name, a SQL expression over the columns, or a Column."""
    return [k if isinstance(k, Column) else F.col(k) if k in df.columns else F.expr(k) for k in keys]


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (ascending, NULLs first).

    ``keys`` may be expressions (e.g. ``"coalesce(a, -1)"``), so that NULL and -1 are one key.
    To prefer NULLs last or a descending value, pass a transformed column
    (``x.isNotNull()``, ``-x``) in ``order``.  Returns the columns of ``df``.
    """
    key_cols = key_columns(df, keys)
    ordered = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                       F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    best = (df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(key_cols)])
            .agg(F.max(ordered).alias("_best")))
    return best.select(F.col("_best._row.*"))


def upsert_last_wins(target: DataFrame, batch: DataFrame, keys: Sequence[str | Column],
                     seq: Column) -> DataFrame:
    """Resulting table state of a keyed upsert: all non-key columns replaced by
    the latest row of the batch; rows of the target with no batch row stay.

    Batch rows beat target rows with the same key (``_side`` = 1), and among
    batch rows the greatest ``seq`` wins.
    """
    t = target.withColumn("_side", F.lit(0)).withColumn("_seq", seq)
    b = batch.withColumn("_side", F.lit(1)).withColumn("_seq", seq)
    both = t.unionByName(b)
    return latest_per_key(both, keys, [F.col("_side"), F.col("_seq")]).drop("_side", "_seq")
