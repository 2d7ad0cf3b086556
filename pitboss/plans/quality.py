"""Run-window resolution, health check and row-count snapshot.

All three are aggregates that return one-row (or few-row) DataFrames; the
caller decides whether to collect the scalar.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _d(day: dt.date):
    return F.lit(day.isoformat()).cast("date")


def refresh_window(target: DataFrame, day_col: str, yesterday: dt.date, lookback_days: int | None = None,
                   anchor: dt.date | None = None) -> DataFrame:
    """Days to refresh (K1).  Catch-up mode: if the last loaded day is before
    ``yesterday``, refresh from that day (inclusive) to yesterday; otherwise, or
    for an empty target, yesterday only.  With ``lookback_days`` the window is
    the fixed ``anchor - N .. anchor``."""
    last = target.agg(F.max(day_col).alias("last_loaded_day"))
    if lookback_days is not None:
        a = anchor or yesterday
        return last.select("last_loaded_day", _d(a - dt.timedelta(days=lookback_days)).alias("from_day"),
                           _d(a).alias("to_day"), F.lit("lookback").alias("mode"))
    behind = F.col("last_loaded_day").isNotNull() & (F.col("last_loaded_day") < _d(yesterday))
    return last.select("last_loaded_day",
                       F.when(behind, F.col("last_loaded_day")).otherwise(_d(yesterday)).alias("from_day"),
                       _d(yesterday).alias("to_day"),
                       F.when(behind, "catchup").otherwise("daily").alias("mode"))


def health_check(target: DataFrame, day_col: str, day: dt.date) -> DataFrame:
    """Whether the target has rows for ``day`` (K2); stops at the first row."""
    probe = target.filter(F.col(day_col) == _d(day)).select(F.lit(1).alias("_x")).limit(1)
    return probe.agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(_d(day).alias("day"), "has_rows")


def row_count_snapshot(tables: Mapping[str | tuple[str, ...], DataFrame | tuple]) -> DataFrame:
    """Row counts of several tables/ranges as one DataFrame.

    Several names may share one table, each with its own filter (None: all
    rows), given as ``(table, [filters])``: the table is read once for them."""
    out = None
    for names, held in tables.items():
        names = (names,) if isinstance(names, str) else names
        df, filters = held if isinstance(held, tuple) else (held, [None] * len(names))
        counts = df.agg(*[(F.count(F.lit(1)) if f is None else F.count_if(f)).alias(f"_{i}") for i, f in enumerate(filters)])
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("table_name"), F.col(f"_{i}").alias("rows"))
                                    for i, n in enumerate(names)])).alias("_row")
        row = counts.select(pairs).select("_row.table_name", "_row.rows")
        out = row if out is None else out.unionByName(row)
    return out
