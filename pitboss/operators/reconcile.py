"""Multiset reconciliation of two result sets (H3).

Counting instead of ``exceptAll`` twice: both sides are stacked with
a mark of their side and grouped by every column once (grouping is NULL-safe, and the counts
combine map-side), so one shuffle yields both directions and multiplicities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_difference(left: DataFrame, right: DataFrame, cols: Sequence[str], left_label: str = "only_in_left",
                        right_label: str = "only_in_right") -> DataFrame:
    """Rows whose multiplicity differs: ``side`` names the side with the surplus,
    ``n`` the number of surplus copies."""
    net = copies(left, right, cols).withColumn("_net", F.col("_left") - F.col("_right")).filter(F.col("_net") != 0)
    return net.select(F.when(F.col("_net") > 0, F.lit(left_label)).otherwise(F.lit(right_label)).alias("side"),
                      *cols, F.abs("_net").cast("long").alias("n"))


def copies(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How often each row stands on either side (``_left``, ``_right``)."""
    a = left.select(*cols).withColumn("_w", F.lit(1))
    b = right.select(*cols).withColumn("_w", F.lit(-1))
    return a.unionByName(b).groupBy(*cols).agg(F.count_if(F.col("_w") > 0).alias("_left"),
                                               F.count_if(F.col("_w") < 0).alias("_right"))


def difference_totals(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: rows per side and surplus copies per side, from one pass over both."""
    surplus = F.col("_left") - F.col("_right")
    return copies(left, right, cols).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for c, name in (
            (F.col("_left"), "left_rows"), (F.col("_right"), "right_rows"),
            (F.greatest(surplus, F.lit(0)), "only_in_left"), (F.greatest(-surplus, F.lit(0)), "only_in_right"))])
