"""Merkle manifest of a dataset by slot pivots.

Rows are leaves; within a group (a language) they stand in the order of
doc_id, and every FANOUT consecutive nodes are one run, whose parent is the
digest of their digests.  One level is one aggregation: conditional aggregates
spread a run's children into FANOUT slot columns, the concatenated columns are
hashed, and a child's siblings are the columns without its own slot.  The
groups' roots are the leaves of a second tree of the same kind.

Going up, every level is written once (an eighth of the one below).  Going
down, a run hands each child its path: the digests left and right of it, level
by level.  A leaf gets its path from its parent's row, so paths cross the
network once per run, not once per leaf.  Every key is a run of at most FANOUT
nodes: no group, however large, meets in one task.  Texts are hashed where
they are read.

Places in a group come from a range partitioning of (group, doc_id): number
within the partition plus the rows of earlier partitions.

Defined cases: a null in any column is written `-`; null doc_ids come first
and are never tampered; rows that share a doc_id stand in the order of their
digests, so repeated rows are leaves of their own; a lone leaf is its group's
root; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = [f"slot{j}" for j in range(FANOUT)]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def written(value: Column) -> Column:
    """`-` for null, else byte count, `:`, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(columns: dict[str, Column]) -> Column:
    return digest(*[written(columns[f]) for f in FIELDS])


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df(group, ...)`` with ``place``, a row's number from 0 within its group in
    the order of ``order``, and ``n``, the rows of the group."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = materialize(df.repartitionByRange(parts, "group", *order).sortWithinPartitions("group", *order)
                         .withColumn("__part", F.spark_partition_id())
                         .withColumn("__at", F.monotonically_increasing_id()))
    # one row per group and partition that has it
    runs = placed.groupBy("group", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    group = Window.partitionBy("group")
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("group", "__part", F.sum("__rows").over(group).alias("n"),
                       (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return (placed.join(runs, ["group", "__part"]).withColumn("place", F.col("__at") + F.col("__shift"))
            .drop("__part", "__at", "__shift"))


def build(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``leaves(group, place, n, digest)`` and the groups' roots.

    Level k holds the runs of the nodes at height k: (group, place, n, slots),
    ``n`` being the runs of the group.  Roots: (group, depth, root)."""
    nodes = leaves.select("group", "place", "n", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], None
    while True:
        done = nodes.where("n = 1").select("group", F.lit(len(levels)).alias("depth"), F.col("digest").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        if most <= 1:
            return levels, materialize(roots)
        slot = F.pmod("place", F.lit(FANOUT))
        runs = (nodes.where("n > 1")
                .groupBy("group", F.expr(f"place div {FANOUT}").alias("place"),
                         F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"))
                .agg(*[F.max(F.when(slot == j, F.col("digest"))).alias(c) for j, c in enumerate(SLOTS)]))
        levels.append(materialize(runs))
        nodes = levels[-1].select("group", "place", "n", F.sha2(F.concat_ws("", *SLOTS), 256).alias("digest"))
        most = -(-most // FANOUT)


def step(slot: Column) -> Column:
    """What stands left and right of a slot in its run."""
    left = F.concat_ws("", *[F.when(slot > j, F.col(c)) for j, c in enumerate(SLOTS)])
    right = F.concat_ws("", *[F.when(slot < j, F.col(c)) for j, c in enumerate(SLOTS)])
    return F.struct(left.alias("left"), right.alias("right"))


NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


def attach(leaves: DataFrame, levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """``leaves`` with the columns of ``roots(group, depth, path, ...)``, the path
    led on from the root of the group down to each leaf."""
    carried = [c for c in roots.columns if c not in ("group", "depth", "path")]

    def starting(depth: int) -> DataFrame:
        return roots.where(F.col("depth") == depth).select("group", F.lit(0).cast("long").alias("place"), "path", *carried)

    out = leaves.where("n = 1").join(starting(0).drop("place"), "group")
    if levels:
        above = starting(len(levels))
        for k in range(len(levels) - 1, 0, -1):
            kids = F.posexplode(F.array(*SLOTS)).alias("slot", "child")
            above = (levels[k].join(above, ["group", "place"]).select("*", kids).where("child IS NOT NULL")
                     .select("group", (F.col("place") * FANOUT + F.col("slot")).alias("place"),
                             F.concat(F.array(step(F.col("slot"))), F.col("path")).alias("path"), *carried)
                     .unionByName(starting(k)))
        runs = levels[0].drop("n").join(above, ["group", "place"]).withColumnRenamed("place", "__run")
        slot = F.pmod("place", F.lit(FANOUT))
        led = (leaves.where("n > 1").withColumn("__run", F.expr(f"place div {FANOUT}")).join(runs, ["group", "__run"])
               .withColumn("path", F.concat(F.array(step(slot)), F.col("path"))))
        out = out.unionByName(led.select(*out.columns))
    return out


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along ``path``."""
    return F.aggregate(path, start, lambda node, at: digest(at["left"], node, at["right"]))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root) of every row.

    ``altered`` replaces columns after the manifest was made (none: nothing was
    altered); ``folded_root`` is the root recomputed from the altered row and
    the original siblings."""
    plain = {f: F.col(f) for f in FIELDS}
    rows = materialize(docs.select(
        written(F.col("lang")).alias("group"), F.col("lang").cast("string").alias("lang"),
        F.col("doc_id").cast("long").alias("doc_id"), row_digest(plain).alias("digest"),
        row_digest(plain | (altered or {})).alias("now"),
        F.monotonically_increasing_id().alias("copy")))  # parts rows that are equal in all else
    leaves = materialize(ranked(rows, [F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("copy")]).drop("copy"))
    levels, tops = build(leaves)
    langs = tops.join(leaves.where("place = 0").select("group", "lang"), "group")
    upper = materialize(ranked(langs.select(F.lit("all").alias("group"), "lang", F.col("group").alias("lower"), "depth",
                                            F.col("root").alias("digest")), [F.asc_nulls_first("lang")]))
    upper_levels, summit = build(upper)
    summit = summit.select("group", "depth", F.expr(NO_PATH).alias("path"), "root")
    tops = (attach(upper.withColumnRenamed("depth", "lower_depth"), upper_levels, summit)
            .select(F.col("lower").alias("group"), F.col("lower_depth").alias("depth"), "path",
                    F.col("digest").alias("subroot"), "root"))
    return (attach(leaves, levels, materialize(tops))
            .select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path",
                    folded(F.col("now"), F.col("path")).alias("folded_root")))


def tampered() -> dict[str, Column]:
    """Lower-cased text of the rows whose doc_id has a CRC that 3 divides."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return {"text": F.when(hit, F.translate(F.col("text"), UPPER, LOWER)).otherwise(F.col("text"))}


def verification(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and whether each row still leads to the root after tampering."""
    return manifest(docs, tampered()).select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
