"""Ordered scans (running sums, row numbers, carried values) that split hot groups.

A plain ``Window.partitionBy(keys).orderBy(...)`` puts every row of a key in
one task; if one key holds a third of all rows, that task holds a third of
the data.  The scans here are *two-level*: the caller names a ``chunk``
expression that is monotone in the order within a key (an hour bucket of the
time column, a range bucket of an id, ...).

1. Level 1 runs the window per ``(keys, chunk)``: bounded by the chunk size.
2. A per-chunk summary (total, count, last value) is aggregated with partial
   (map-side) aggregation.
3. Level 2 scans the summaries per key, ordered by chunk.  There is one row
   per chunk, so even a hot key has few rows here.
4. The carried prefix of the previous chunks is joined back on
   ``(keys, chunk)``.

``balanced_chunks`` makes the chunk of a busy group from its own quantiles, so
that many rows of one key in one hour, or at one instant, are split as well.

The results equal the one-level window exactly (the operations are
associative), for NULL values and NULL keys too.  The chunk value must not be
NULL (the scan raises on one); callers map NULL order values to a sentinel
that sorts where the one-level window would put them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_CHUNK = "_chunk"


def _prefix_before(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(F.col(_CHUNK)).rowsBetween(Window.unboundedPreceding, -1)


def with_chunk(df: DataFrame, chunk: Column) -> DataFrame:
    """``df`` with the chunk column; a NULL chunk is an error of the caller."""
    bad = F.raise_error(F.lit("chunk of an ordered scan is NULL: map NULL order values to a sentinel"))
    return df.withColumn(_CHUNK, F.when(chunk.isNull(), bad).otherwise(chunk))


# Rows of one chunk of a busy group, and chunks of one group and hour at most
# (an hour with more rows has longer chunks, not fewer rows).
CHUNK_ROWS = 1 << 18
HOUR_CHUNKS = 512


def balanced_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], coarse: Column,
                    counted: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, Column]:
    """``df`` and a chunk for the scans below that stays small however the rows of a
    key crowd together: ``coarse`` (an hour, say), and where one group has more
    than ``chunk_rows`` rows in it, the row's place among cuts of that group.

    ``order`` holds ascending columns (NULLs first, see ``nulls_last``) that
    agree with the order of the scan.  The busy groups are counted first, and
    their cuts are quantiles of (key, order) from Spark's range partitioning;
    both are checkpointed, since a plan that uses the chunks twice has to see
    the same cuts.  ``counted`` may name a cheaper plan of the same rows.
    Without a busy group nothing is added to the plan."""
    rows = df if counted is None else counted
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sizes = (rows.groupBy(*[F.col(k).alias(f"_hot_{k}") for k in keys], coarse.alias("_hot_coarse"))
             .agg(F.count(F.lit(1)).alias("_hot_rows")).filter(F.col("_hot_rows") > chunk_rows)).checkpoint()
    total = sizes.agg(F.sum("_hot_rows")).first()[0]
    if not total:
        return df, coarse
    names = [f"_hot_{k}" for k in keys] + ["_hot_coarse"]

    def same(right: list[str]) -> Column:
        out = F.lit(True)
        for here, there in zip([*[F.col(k) for k in keys], coarse], right):
            out = out & here.eqNullSafe(F.col(there))
        return out
    busy = rows.join(sizes, same(names), "inner").select(*names, F.struct(*order).alias("_place"))
    parts = -(-total // chunk_rows) + 1
    first = (busy.repartitionByRange(parts, *names, "_place").withColumn("_part", F.spark_partition_id())
             .groupBy("_part", *names).agg(F.min("_place").alias("_cut")))
    every = F.greatest(F.lit(1), F.ceil(F.size("_all") / F.lit(HOUR_CHUNKS)).cast("int"))
    cuts = (first.groupBy(*names).agg(F.sort_array(F.collect_list("_cut")).alias("_all"))
            .select(*names, F.filter("_all", lambda c, i: i % every == 0).alias("_cuts"))).checkpoint()
    placed = df.join(cuts, same(names), "left").withColumn(
        "_sub", F.when(F.col("_cuts").isNull(), 0).otherwise(
            F.size(F.filter("_cuts", lambda c: c <= F.struct(*order))))).drop(*names, "_cuts")
    return placed, F.struct(coarse.alias("coarse"), F.col("_sub").alias("sub"))


def nulls_last(*columns: Column) -> list[Column]:
    """Ascending order columns that put NULLs last."""
    return [part for c in columns for part in (c.isNull(), c)]


def join_back(rows: DataFrame, summary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join on ``cols`` in which NULL keys match, as in a window partition."""
    right = summary.withColumnsRenamed({c: f"_back_{c}" for c in cols})
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_back_{c}"))
    return rows.join(right, same, "inner").drop(*[f"_back_{c}" for c in cols])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str,
                chunk: Column | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per key in ``order`` (ROWS frame)."""
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    d = with_chunk(df, chunk).withColumn("_v", value)
    w1 = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_local", F.sum("_v").over(w1))
    summary = (d.groupBy(*keys, _CHUNK).agg(F.sum("_v").alias("_tot"))
               .withColumn("_off", F.sum("_tot").over(_prefix_before(keys)))
               .select(*keys, _CHUNK, "_off"))
    joined = join_back(d, summary, [*keys, _CHUNK])
    # SUM skips NULLs: a part without values leaves the other as it is
    res = F.coalesce(F.col("_local") + F.col("_off"), F.col("_local"), F.col("_off"))
    return joined.withColumn(out, res).drop(_CHUNK, "_v", "_local", "_off")


def chunked_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str,
                       chunk: Column | None = None) -> DataFrame:
    """ROW_NUMBER per key in ``order``; with ``chunk`` a hot key is split."""
    if chunk is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return running_sum(df, keys, order, F.lit(1).cast("long"), out, chunk)


def max_prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str,
                   chunk: Column | None = None) -> DataFrame:
    """Per key: ``max(0, max_k sum_{j<=k} value_j)`` in ``order``; one row per key.

    Segments combine associatively as (total, best) pairs:
    ``(t1, b1) + (t2, b2) = (t1 + t2, max(b1, t1 + b2))``, so the scan over the
    chunk summaries is exact.
    """
    d = df.withColumn("_v", value)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumn("_run", F.sum("_v").over(w))
        return d.groupBy(*keys).agg(F.greatest(F.max("_run"), F.lit(0)).alias(out))
    seg = prefix_peaks(df, keys, order, value, "_peak", chunk)
    return seg.groupBy(*keys).agg(F.greatest(F.max("_peak"), F.lit(0)).alias(out))


def prefix_peaks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str,
                 chunk: Column, aggs: Sequence[Column] = ()) -> DataFrame:
    """Per (key, chunk): the greatest prefix sum of ``value`` reached within the
    chunk, counted from the key's first row, together with other aggregates of
    the chunk's rows; the rows are shuffled once for both."""
    d = with_chunk(df.withColumn("_v", value), chunk)
    w1 = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seg = (d.withColumn("_run", F.sum("_v").over(w1))
           .groupBy(*keys, _CHUNK).agg(F.sum("_v").alias("_tot"), F.max("_run").alias("_best"), *aggs))
    before = F.coalesce(F.sum("_tot").over(_prefix_before(keys)), F.lit(0))
    return seg.withColumn(out, before + F.col("_best")).drop(_CHUNK, "_tot", "_best")


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column], payload: str, out: str,
               chunk: Column | None = None, inclusive: bool = True, keep: Column | None = None) -> DataFrame:
    """Last non-null ``payload`` per key up to each row (LAST ... IGNORE NULLS).

    ``inclusive=False`` looks at the preceding rows only (a LAG that skips
    nulls).  With ``chunk`` the value carried into each chunk comes from the
    per-chunk last values of the previous chunks.  ``keep`` filters the rows
    returned (e.g. probe rows only) before the chunk prefix is joined back.
    ``order`` must be plain ascending columns (their struct order is used).
    """
    end = 0 if inclusive else -1
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        res = df.withColumn(out, F.last(payload, ignorenulls=True).over(w))
        return res if keep is None else res.filter(keep)
    d = with_chunk(df, chunk)
    w1 = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    d = d.withColumn("_local", F.last(payload, ignorenulls=True).over(w1))
    # Per chunk: the last non-null payload in chunk order.  ``order`` is
    # reproduced as a struct so max_by picks the same row as the window.
    ordkey = F.struct(*list(order))
    # One aggregate gives every chunk and its last value (max_by skips rows
    # whose ordering value is NULL, i.e. rows without a payload).
    chunks = d.groupBy(*keys, _CHUNK).agg(
        F.max_by(F.col(payload), F.when(F.col(payload).isNotNull(), ordkey)).alias("_last"))
    chunks = (chunks.withColumn("_chunk_prev", F.last("_last", ignorenulls=True).over(_prefix_before(keys)))
              .select(*keys, _CHUNK, "_chunk_prev"))
    rows = d if keep is None else d.filter(keep)
    joined = join_back(rows, chunks, [*keys, _CHUNK])
    return joined.withColumn(out, F.coalesce(F.col("_local"), F.col("_chunk_prev"))).drop(_CHUNK, "_local", "_chunk_prev")
