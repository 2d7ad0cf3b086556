"""Sharding by Hilbert-curve order (operator 3).

Several metadata dimensions are quantised to 2**BITS levels of near equal
frequency (order-preserving, from approximate percentiles of all rows), a
row's levels give its index on a Hilbert curve, and rows sorted by that index
are cut into runs.  Neighbours on the curve are near in every dimension, so a
shard spans a small box of the dimensions and readers can skip files by the
minima and maxima of any of them.

Law: ``rows``: shards differ by at most one row.  Equal texts are one group:
they take the place of their member with the least doc_id, so that they stand
together in the order and share a shard unless a cut falls among them, which
the law requires when a group is larger than what is left of a shard.

Row numbers come from a range-partitioned sort: each partition is numbered by
itself and its offset is the sum of the counts before it (one count a
partition goes through the driver).

Defined cases: a null text has size 16 and the crc32 of the empty text; null
dimensions take level 0; rows with a null doc_id sort before others of their
text; repeated rows get a slot each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

BITS = 5


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points (rows) with coordinates below 2**bits.

    The coordinates are turned into the transposed index by undoing the
    curve's rotations from the highest bit down; its bits are then interleaved.
    """
    x = levels.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(n):
            set_ = (x[i] & high) > 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= np.where(set_, 0, swap) if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & (1 << bit)) > 0, (1 << bit) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def ordinal(column: Column) -> Column:
    """A string as a number in the same order: its first six bytes."""
    head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def curve_index(docs: DataFrame, dimensions: list[str]) -> DataFrame:
    """``docs`` with a column ``curve``: Hilbert index of numeric dimension columns."""
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    edges = docs.agg(*[F.percentile_approx(d, shares, 10_000).alias(d) for d in dimensions]).first()
    # a value's level is its first place among the edges: frequent values keep their share of the range
    cuts = [np.array(edges[d] or [], np.float64) for d in dimensions]

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        levels = [np.where(np.isnan(c := column.to_numpy(np.float64, na_value=np.nan)), 0,
                           np.searchsorted(cut, c, "left")) for cut, column in zip(cuts, columns, strict=True)]
        return pd.Series(hilbert_index(np.stack(levels, axis=1), BITS))
    return docs.withColumn("curve", index(*[F.col(d) for d in dimensions]))


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with ``__row``: the row's number in the order of ``order``, and the row count."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism,
                int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("__part", F.spark_partition_id())
                         .withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = dict(placed.groupBy("__part").count().collect())  # one row a partition
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part] = total
        total += counts[part]
    if not total:
        return placed.withColumn("__row", F.col("__at")).drop("__part", "__at"), 0
    start = F.create_map(*[F.lit(x) for item in starts.items() for x in item])
    return placed.withColumn("__row", start[F.col("__part")] + F.col("__at")).drop("__part", "__at"), total


def shards(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        ordinal(F.col("lang").cast("string")).alias("d_lang"),
        ordinal(F.col("source").cast("string")).alias("d_source"))
    dims = ["d_lang", "d_source", "d_size"]
    rows = curve_index(materialize(rows.withColumn("d_size", F.col("size").cast("double"))), dims)
    # a group of equal texts stands where its first member stands
    first = (rows.groupBy("group", "text_crc32", "size")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "curve")).alias("first"))
             .select(F.col("group").alias("__group"), F.col("text_crc32").alias("__crc"),
                     F.col("size").alias("__size"), F.col("first.curve").alias("place")))
    placed = rows.join(first, (F.col("group") == F.col("__group")) & (F.col("text_crc32") == F.col("__crc"))
                       & (F.col("size") == F.col("__size")))
    ordered, total = numbered(placed.select("doc_id", "size", "text_crc32", "place", "group", "curve"),
                              ["place", "group", "text_crc32", "doc_id"])
    # shard s has the rows from ceil(s * total / n) to below ceil((s + 1) * total / n)
    shard = F.expr(f"__row * {n_shards} div {max(1, total)}")
    start = F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")
    return (ordered.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("__row") - start)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), F.col("place").alias("curve")))
