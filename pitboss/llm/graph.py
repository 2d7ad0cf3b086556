"""Connected components of an edge table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_size, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges(a, b)``: label is the smallest node
    of its component.  Nodes without an edge are not listed.

    Each round takes the least label of a node's neighbours and then the
    label's own label (pointer jumping), until no label changes.  Sums are
    pre-aggregated before each shuffle; no group is collected.  No table has
    more than two rows an edge, and each is written in tasks of that size.
    """
    most = 2 * edges.count()
    both = materialize(by_size(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                               .where("a <> b").distinct(), most))
    labels = materialize(by_size(both.groupBy(F.col("a").alias("node"))
                                 .agg(F.least(F.min("b"), F.first("a")).alias("label")), most))
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        hooked = (labels.join(near, labels["node"] == near["a"])
                  .select("node", "label", F.least("label", "near").alias("now")))
        target = hooked.select(F.col("node").alias("__target"), F.col("now").alias("__label"))
        moved = materialize(by_size(hooked.join(target, hooked["now"] == target["__target"], "left")
                                    .select("node", F.coalesce("__label", "now").alias("now"), "label"), most))
        changed = moved.where("now <> label").limit(1).count()
        labels = moved.select("node", F.col("now").alias("label"))
        if not changed:
            return labels


def contracted(edges: DataFrame) -> DataFrame:
    """The same as ``components``, for graphs that need many rounds.

    Each round takes the least label around each node and that label's own label,
    then goes on with the edges between different labels only: a node costs little
    more than its first round.  The rounds' labels are put together from the last back."""
    edges = edges.select("a", "b").where("a <> b")
    left = materialize(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    rounds = []
    while not rounds or left.limit(1).count():
        near = materialize(left.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("near")))
        its = near.select(F.col("node").alias("__node"), F.col("near").alias("label"))
        rounds.append(materialize(near.join(its, F.col("near") == F.col("__node")).select("node", "label")))
        one, other = (rounds[-1].select(F.col("node").alias(f"__{end}"), F.col("label").alias(f"__label_{end}"))
                      for end in ("a", "b"))
        left = materialize(left.join(one, F.col("a") == F.col("__a")).join(other, F.col("b") == F.col("__b"))
                           .where("__label_a <> __label_b")
                           .select(F.col("__label_a").alias("a"), F.col("__label_b").alias("b")).distinct())
    labels = rounds.pop()
    while rounds:
        last = labels.select(F.col("node").alias("__node"), F.col("label").alias("__label"))
        labels = materialize(rounds.pop().join(last, F.col("label") == F.col("__node"), "left")
                             .select("node", F.coalesce("__label", "label").alias("label")))
    return labels
