"""Running-pool ("clean drop") calculation.

Cash-outs fill a pool and buy-ins first consume the pool; only the part of a
buy-in the pool cannot cover is new money ("clean drop").  Row by row:

    S_k        = running sum of (out - buy)                 (E1)
    min_k      = running min of S                           (E2)
    pool_after = S_k - min(0, min_k)                        (E4)
    pool_before= lag(pool_after, 1, 0)                      (E3)
    clean_k    = buy_k - min(buy_k, max(pool_before, 0))    for buy_k > 0

Summed per group, the clean drop telescopes to a closed form:
``sum(clean) = max(0, max_k sum_{j<=k} (buy_j - out_j))`` -- the largest
running net buy-in.  That is a maximum prefix sum, an associative scan, so
``pitboss.operators.scan.max_prefix_sum`` evaluates it per chunk and combines
the chunks: a member-day (or member) with a huge number of operations is
split over many tasks instead of one.  ``pool_trace`` keeps the row-level
form for callers that need the per-row pool.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import balanced_chunks, join_back, max_prefix_sum, nulls_last

DEC = "decimal(19,4)"
# NULL operation times sort after every real time (ascending, NULLs last).
LATE_SENTINEL = "9999-12-31 00:00:00"


def hour_chunk(ts: Column | str) -> Column:
    """Chunk of an ordered scan on a timestamp: its hour; NULL goes last."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.date_trunc("hour", c), F.lit(LATE_SENTINEL).cast("timestamp_ntz"))


def clean_drop(events: DataFrame, keys: Sequence[str], time_col: str, id_col: str,
               buy: str = "buyamt", out: str = "outamt", result: str = "totaldrop_clean",
               split_hot_groups: bool = True) -> DataFrame:
    """Per group: the clean drop, ordered by (time ASC NULLS LAST, id)."""
    order = [F.col(time_col).asc_nulls_last(), F.col(id_col).asc()]
    chunk = None
    if split_hot_groups:
        events, chunk = balanced_chunks(events, keys, [*nulls_last(F.col(time_col)), F.col(id_col)], hour_chunk(time_col))
    res = max_prefix_sum(events, keys, order, F.col(buy) - F.col(out), result, chunk)
    return res.withColumn(result, F.col(result).cast(DEC))


def pool_trace(events: DataFrame, keys: Sequence[str], time_col: str, id_col: str,
               buy: str = "buyamt", out: str = "outamt", split_hot_groups: bool = True) -> DataFrame:
    """Row-level pool: running sum ``s``, running min ``mins``, pool after and before.

    One-level form: the three windows share one partitioning and ordering, so
    Spark evaluates them after a single exchange and sort.  Two-level form
    (default): the windows run per chunk (hours; a busy hour is split); per chunk the total and the
    minimum running sum are kept; a scan over the chunks gives each one its
    offset (sum of the earlier chunks) and the minimum reached before it:

        s    = offset + local_s
        mins = least(min_before, offset + local_min)
        pool_before of a chunk's first row = offset - least(min_before, 0)
    """
    order = [F.col(time_col).asc_nulls_last(), F.col(id_col).asc()]
    d = events.withColumn("_d", (F.col(out) - F.col(buy)).cast(DEC))
    if not split_hot_groups:
        w = Window.partitionBy(*keys).orderBy(*order)
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumn("s", F.sum("_d").over(run).cast(DEC))
        d = d.withColumn("mins", F.min("s").over(run))
        d = d.withColumn("poolafter", (F.col("s") - F.least(F.col("mins"), F.lit(0))).cast(DEC))
        d = d.withColumn("poolbefore", F.lag("poolafter", 1, 0).over(w).cast(DEC))
        return _with_clean(d.drop("_d"), buy)
    d, chunk = balanced_chunks(d, keys, [*nulls_last(F.col(time_col)), F.col(id_col)], hour_chunk(time_col))
    d = d.withColumn("_chunk", chunk)
    w1 = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    run1 = w1.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_ls", F.sum("_d").over(run1)).withColumn("_lmin", F.min("_ls").over(run1)) \
         .withColumn("_first", F.row_number().over(w1) == 1) \
         .withColumn("_lprev", F.lag("_ls", 1).over(w1)).withColumn("_lprevmin", F.lag("_lmin", 1).over(w1))
    seg = d.groupBy(*keys, "_chunk").agg(F.sum("_d").alias("_tot"), F.min("_ls").alias("_cmin"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_off", F.coalesce(F.sum("_tot").over(before), F.lit(0)))
    seg = seg.withColumn("_minb", F.min(F.col("_off") + F.col("_cmin")).over(before))
    j = join_back(d, seg.select(*keys, "_chunk", "_off", "_minb"), [*keys, "_chunk"])
    s_ = F.col("_off") + F.col("_ls")
    mins = F.least(F.col("_minb"), F.col("_off") + F.col("_lmin"))          # least skips NULL _minb
    prev_s = F.col("_off") + F.col("_lprev")
    prev_min = F.least(F.col("_minb"), F.col("_off") + F.col("_lprevmin"))
    first_before = F.when(F.col("_minb").isNull(), F.lit(0)).otherwise(F.col("_off") - F.least(F.col("_minb"), F.lit(0)))
    j = j.select(*events.columns, s_.cast(DEC).alias("s"), mins.cast(DEC).alias("mins"),
                 (s_ - F.least(mins, F.lit(0))).cast(DEC).alias("poolafter"),
                 F.when(F.col("_first"), first_before).otherwise(prev_s - F.least(prev_min, F.lit(0)))
                 .cast(DEC).alias("poolbefore"))
    return _with_clean(j, buy)


def _with_clean(d: DataFrame, buy: str) -> DataFrame:
    b, before = F.col(buy), F.col("poolbefore")
    clean = F.when(b > 0, b - F.when(before > 0, F.least(b, before)).otherwise(F.lit(0))).otherwise(F.lit(0))
    return d.withColumn("clean", clean.cast(DEC))
