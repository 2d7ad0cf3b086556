"""Exact top-k inner products by best-first search of an M-tree (operator 5).

Components become integers floor(scale * x).  A vector x is lifted to
(x, sqrt(M2 - |x|^2)) with M2 the largest squared norm and a query to (q, 0):
the squared Euclidean distance is then |q|^2 + M2 - 2 <q, x>, so nearest in
the metric is highest in the inner product, and the metric tree applies.

The upper tree is built from a bounded sample: every node has a routing vector
taken from it, a covering radius over all rows below it (measured on the whole
table) and its distance to its parent's routing vector.  All rows descend to
the nearest routing vector on each level and end in subtrees; a subtree too
large for a task (equal vectors have no size limit) is dealt to several parts.
A part is cut into pages of at most PAGE vectors around a routing vector, with
covering radius and every member's distance to it.

A query first searches its own part; its k-th best score there is the reach of
everything that follows.  It then descends the upper tree: a child whose
stored parent distance already puts it out of reach is passed over without
computing its distance, one whose distance less its radius is out of reach is
left with all below it, and only the subtrees that remain become (query,
subtree) rows.  Inside a part, pages are visited in the order of their lower
bound d(q, routing) - radius until the bound exceeds the k-th best; a member
is computed only if |d(q, routing) - d(member, routing)| leaves it open.

All rows are indexed and results are exact: bounds are taken in units of the
largest component and loosened for rounding, and scores are integer products
(in floating point only while they fit 53 bits, beyond 62 bits by big numbers).

Defined cases: vectors that are null or have a null or non-finite component
take no part; any finite component does, and a score beyond the range of a
long is given as the limit of that range (ties there go to the smaller
vec_id); vectors of different lengths are compared as if padded with zeros;
repeated vec_ids are separate rows and a query is not compared with rows of
its own vec_id; rows with a null vec_id take no part; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialize, small_batches

PAGE = 128
SUBTREE = 8192
BLOCK = 2048
# Rows of the sample that the upper tree's routing vectors come from, and children of a node.
SAMPLE = 4096
FANOUT = 16
SLACK = 1e-9
# No score yet; scores are kept above it.
NONE = -(2 ** 63 - 1)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    out = np.zeros((len(column), width))
    lengths = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = column.flatten().to_numpy()
    return out


class Page:
    __slots__ = ("rows", "routing", "radius", "parent")

    def __init__(self, lifted: np.ndarray, rows: np.ndarray):
        self.rows = rows
        self.routing = lifted[rows].mean(axis=0)
        self.parent = np.linalg.norm(lifted[rows] - self.routing, axis=1)
        self.radius = float(self.parent.max())


def pages_of(lifted: np.ndarray, rows: np.ndarray) -> list[Page]:
    """Pages of at most PAGE rows: split by two far routing rows, halved when they tie."""
    todo, pages = [rows], []
    while todo:
        rows = todo.pop()
        if len(rows) <= PAGE:
            pages.append(Page(lifted, rows))
            continue
        x = lifted[rows]
        a = x[np.argmax(((x - x[0]) ** 2).sum(axis=1))]
        b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
        order = np.argsort(((x - a) ** 2).sum(axis=1) - ((x - b) ** 2).sum(axis=1), kind="stable")
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return pages


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of vectors of whole numbers, limited to the range of a long."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if top < 2 ** 53:
        return (queries @ vectors.T).astype(np.int64)
    if top < 2 ** 62:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = [[[int(x) for x in row] for row in side] for side in (queries, vectors)]
    exact = [[sum(x * y for x, y in zip(q, v, strict=True)) for v in whole[1]] for q in whole[0]]
    return np.array([[max(NONE + 1, min(2 ** 63 - 1, x)) for x in row] for row in exact], np.int64)


def reach_of(square: np.ndarray, bound: float, floor: np.ndarray) -> np.ndarray:
    """How far from a query a vector may be that scores at least ``floor``."""
    return np.sqrt(np.maximum(0, square + bound - 2 * floor)) * (1 + SLACK) + 1e-7 * np.sqrt(square + bound)


def distances(queries: np.ndarray, square: np.ndarray, routing: np.ndarray) -> np.ndarray:
    """Of queries (lifted by 0) to lifted routing vectors."""
    return np.sqrt(np.maximum(0, square[:, None] + (routing ** 2).sum(axis=1) - 2 * queries @ routing[:, :-1].T))


def lift(vectors: np.ndarray, bound: float) -> np.ndarray:
    return np.concatenate([vectors, np.sqrt(np.maximum(0, bound - (vectors ** 2).sum(axis=1)))[:, None]], axis=1)


class Upper:
    """The tree above the subtrees: routing vectors, parents' distances, radii."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.routing = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])]
        self.children: list[list[int]] = [[]]
        self.parent_far = [0.0]
        self.leaf = [-1]
        self.paths: list[list[int]] = []  # of each subtree, from below the root
        self._grow(0, sample, max(1, leaves), [])
        self.routing = np.stack(self.routing)
        self.parent_far = np.array(self.parent_far)
        self.radius = np.zeros(len(self.routing))

    def _grow(self, node: int, rows: np.ndarray, leaves: int, path: list[int]) -> None:
        picked = self._spread(rows, min(FANOUT, leaves)) if leaves > 1 else []
        if len(picked) < 2:
            self.leaf[node] = len(self.paths)
            self.paths.append(path)
            return
        near = np.argmin(((rows[:, None, :] - rows[picked][None]) ** 2).sum(axis=2), axis=1)
        for i, pick in enumerate(picked):
            child = len(self.routing)
            self.routing.append(rows[pick])
            self.children.append([])
            self.leaf.append(-1)
            self.parent_far.append(float(np.linalg.norm(rows[pick] - self.routing[node])))
            self.children[node].append(child)
            mine = rows[near == i]
            self._grow(child, mine, round(leaves * len(mine) / len(rows)), [*path, child])

    @staticmethod
    def _spread(rows: np.ndarray, n: int) -> list[int]:
        """Places of up to ``n`` rows, each as far as possible from those before."""
        picked = [int(np.argmax(((rows - rows.mean(axis=0)) ** 2).sum(axis=1)))] if len(rows) else []
        far = ((rows - rows[picked[0]]) ** 2).sum(axis=1) if picked else np.zeros(0)
        while len(picked) < n and far.max() > 0:
            picked.append(int(np.argmax(far)))
            far = np.minimum(far, ((rows - rows[picked[-1]]) ** 2).sum(axis=1))
        return picked

    def place(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subtree of each row, and its distance to every routing vector on the way (0 beyond)."""
        depth = max(map(len, self.paths), default=0)
        leaf, far = np.zeros(len(lifted), np.int64), np.zeros((len(lifted), depth))
        todo = [(0, np.arange(len(lifted)), 0)]
        while todo:
            node, rows, level = todo.pop()
            if self.leaf[node] >= 0:
                leaf[rows] = self.leaf[node]
                continue
            routing = self.routing[self.children[node]]
            d = np.stack([np.linalg.norm(lifted[rows] - r, axis=1) for r in routing], axis=1)
            best = np.argmin(d, axis=1)
            far[rows, level] = d[np.arange(len(rows)), best]
            todo += [(child, rows[best == i], level + 1) for i, child in enumerate(self.children[node]) if (best == i).any()]
        return leaf, far

    def measure(self, radii: dict[int, list[float]]) -> None:
        """Covering radii from the largest distances of each subtree's rows."""
        for leaf, path in enumerate(self.paths):
            for node, far in zip(path, radii.get(leaf, [])):
                self.radius[node] = max(self.radius[node], far)

    def within(self, queries: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(query row, subtree) pairs that are not out of reach, and the distances computed."""
        square = (queries ** 2).sum(axis=1)
        every = np.arange(len(queries))
        root = distances(queries, square, self.routing[:1])[:, 0]
        todo, rows, leaves, computed = [(0, every, root)], [], [], len(queries)
        while todo:
            node, active, far = todo.pop()
            if self.leaf[node] >= 0:
                rows.append(active)
                leaves.append(np.full(len(active), self.leaf[node]))
                continue
            for child in self.children[node]:
                # the stored parent distance first: no distance is computed for what it rules out
                open_ = np.abs(far - self.parent_far[child]) - self.radius[child] <= reach[active]
                some = active[open_]
                if not len(some):
                    continue
                d = distances(queries[some], square[some], self.routing[child:child + 1])[:, 0]
                computed += len(some)
                near = d - self.radius[child] <= reach[some]
                if near.any():
                    todo.append((child, some[near], d[near]))
        none = np.zeros(0, np.int64)
        return np.concatenate(rows or [none]), np.concatenate(leaves or [none]), computed


def search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
           bound: float, unit: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-first search of one part: (query row, vector id, score) of each
    query's at most k best scores that are at least its ``floor``.  ``unit``
    scales whole numbers to the metric, in which ``bound`` is given."""
    small = queries * unit
    lifted = lift(vectors * unit, bound)
    pages = pages_of(lifted, np.arange(len(ids)))
    routing = np.stack([p.routing for p in pages])
    radius = np.array([p.radius for p in pages])
    square = (small ** 2).sum(axis=1)
    far = distances(small, square, routing)
    lower = np.maximum(0, far - radius)
    order = np.argsort(lower, axis=1, kind="stable")
    best = np.full((len(queries), k), NONE, np.int64)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    worst = floor.astype(np.int64).copy()
    for turn in range(len(pages)):
        page = order[:, turn]
        # highest score that the page's bound still allows
        at = lower[np.arange(len(queries)), page]
        least = metric_score(worst, unit)
        active = np.flatnonzero((square + bound - at * at) / 2 + SLACK * (square + bound) >= least)
        if not len(active):
            break
        by_page = active[np.argsort(page[active], kind="stable")]
        for group in np.split(by_page, np.flatnonzero(np.diff(page[by_page])) + 1):
            node = pages[page[group[0]]]
            # stored parent distances: members that no query of the group can need
            reach = reach_of(square[group], bound, least[group])
            gap = far[group, page[group[0]]]
            lo, hi = (gap - reach).min(), (gap + reach).max()
            rows = node.rows[(node.parent >= lo) & (node.parent <= hi)]
            if not len(rows):
                continue
            score = products(queries[group], vectors[rows])
            score[ids[rows][None, :] == query_ids[group][:, None]] = NONE
            score[score < worst[group][:, None]] = NONE
            every = np.concatenate([best[group], score], axis=1)
            every_id = np.concatenate([best_id[group], np.broadcast_to(ids[rows], score.shape)], axis=1)
            pick = np.lexsort((every_id, -every), axis=1)[:, :k]
            best[group] = np.take_along_axis(every, pick, axis=1)
            best_id[group] = np.take_along_axis(every_id, pick, axis=1)
            worst[group] = np.maximum(worst[group], best[group][:, -1])
    found = best > NONE
    return np.nonzero(found)[0], best_id[found], best[found]


def metric_score(score: np.ndarray, unit: float) -> np.ndarray:
    """A score in the metric's units; a limited one stands for anything as low."""
    return np.where(score <= NONE + 1, -np.inf, score.astype(np.float64) * unit * unit)


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, vector array<double>): floor(scale * x), whole numbers of any size, of the rows that take part."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    # a function of doubles: FLOOR itself would make longs
    whole = F.transform(x, lambda v: (v.cast("double") * float(scale)))
    return (rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")))


PLACED = "vec_id long, copy long, vector array<double>, leaf int, far array<double>"
RESULT = "query_id long, copy long, vec_id long, score long"


def top_k(rows: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each row
    whose vec_id is divisible by ``every``, ties to the smaller vec_id."""
    spark = rows.sparkSession
    small_batches(spark)

    def floors(batches):
        for batch in batches:
            lists = batch.column("vector")
            flat = pa.array(np.floor(lists.flatten().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("copy"), pa.ListArray.from_arrays(
                    pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32()), flat)],
                names=["vec_id", "copy", "vector"])
    # numbered copies: repeated vec_ids stay apart
    vectors = materialize(whole_vectors(rows, scale).withColumn("copy", F.monotonically_increasing_id())
                          .select("vec_id", "copy", "vector")
                          .mapInArrow(floors, "vec_id long, copy long, vector array<double>"))
    total, width, top = vectors.agg(F.count("*"), F.max(F.size("vector")), F.max(
        F.aggregate("vector", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v))))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not total:
        return empty
    width = max(1, width)
    # a power of two: scaling by it is exact, and squares of scaled components stay in range
    unit = 2.0 ** -math.ceil(math.log2(top)) if top else 1.0
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + (v * unit) * (v * unit))
    bound = float(vectors.agg(F.max(norm)).first()[0]) * (1 + 1e-12)

    # the upper tree's routing vectors: a sample of at most SAMPLE rows
    chosen = vectors.orderBy(F.xxhash64("vec_id", "copy"), "copy").limit(
        min(SAMPLE, 4 * math.ceil(total / SUBTREE))).select("vector").toArrow()
    upper = Upper(lift(_matrix(chosen.column("vector"), width) * unit, bound), math.ceil(total / SUBTREE))

    def descend(batches):
        for batch in batches:
            if batch.num_rows:
                leaf, far = upper.place(lift(_matrix(batch.column("vector"), width) * unit, bound))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(far.tolist(), pa.list_(pa.float64()))],
                    names=["vec_id", "copy", "vector", "leaf", "far"])
    placed = materialize(vectors.mapInArrow(descend, PLACED))
    depth = max(map(len, upper.paths), default=0)
    # one row a subtree: its rows, and their largest distance to each routing vector above
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n"), *[F.max(F.col("far")[i]).alias(f"r{i}")
                                                                   for i in range(depth)]).collect()
    upper.measure({r["leaf"]: [r[f"r{i}"] * (1 + SLACK) + 1e-12 for i in range(depth)] for r in sizes})
    # rounded distances: a query's own descent must not lose what is exactly at the border
    upper.radius += 1e-7 * math.sqrt(bound)
    parts = {r["leaf"]: math.ceil(r["n"] / SUBTREE) for r in sizes}
    first = dict(zip(parts, np.cumsum([0, *parts.values()])[:-1].tolist(), strict=True))
    split = F.create_map(*[F.lit(x) for item in parts.items() for x in item])[F.col("leaf")]
    start = F.create_map(*[F.lit(x) for item in first.items() for x in item])[F.col("leaf")]
    placed = placed.withColumn("part", (start + F.pmod(F.xxhash64("copy"), split)).cast("int"))
    members = placed.select("part", F.col("vec_id").alias("member_id"), F.col("vector").alias("member"))
    queries = placed.where(F.col("vec_id") % every == 0).select("vec_id", "copy", "vector", "part")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: np.zeros(0, np.int64) for c in ("query_id", "copy", "vec_id", "score")}
        if left.num_rows and right.num_rows:
            ids = left.column("vec_id").to_numpy()
            found = search(_matrix(left.column("vector"), width), ids, left.column("floor").to_numpy(),
                           _matrix(right.column("member"), width), right.column("member_id").to_numpy(), bound, unit, k)
            out = {"query_id": ids[found[0]], "copy": left.column("copy").to_numpy()[found[0]],
                   "vec_id": found[1], "score": found[2]}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    def against(asked: DataFrame) -> DataFrame:
        """Each asked (query, part) row's best scores; a part meets its queries in blocks."""
        asked = materialize(asked.withColumn("slice", F.pmod(F.xxhash64("copy", "part"), F.lit(1 << 20))))
        blocks = (asked.groupBy("part").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
                  .withColumnRenamed("part", "__part"))
        left = (asked.join(blocks, F.col("part") == F.col("__part"))
                .withColumn("block", F.expr("cast(slice % blocks AS int)")).drop("__part", "blocks", "slice"))
        right = (members.join(blocks, F.col("part") == F.col("__part"))
                 .select("part", "member_id", "member", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
        return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(run, RESULT)

    # first the query's own part: its k-th best is a floor for all others
    lowest = F.lit(NONE).cast("long")
    near = materialize(against(queries.withColumn("floor", lowest)))
    order = Window.partitionBy("copy").orderBy(F.desc("score"), "vec_id")
    floor = (near.withColumn("n", F.row_number().over(order)).where(F.col("n") == k)
             .select(F.col("copy").alias("__copy"), F.col("score").alias("__floor")))
    found = near
    if sum(parts.values()) > 1:
        floored = (queries.join(floor, F.col("copy") == F.col("__copy"), "left")
                   .select("vec_id", "copy", "vector", "part", F.coalesce("__floor", lowest).alias("floor")))

        def narrow(batches):
            for batch in batches:
                small = _matrix(batch.column("vector"), width) * unit
                least = metric_score(batch.column("floor").to_numpy(), unit)
                row, leaf, _ = upper.within(small, reach_of((small ** 2).sum(axis=1), bound, least))
                home = batch.column("part").to_numpy()
                pairs = [(i, p) for i, one in zip(row.tolist(), leaf.tolist(), strict=True) if one in parts
                         for p in range(first[one], first[one] + parts[one]) if p != home[i]]
                at = pa.array([i for i, _ in pairs], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(at) for c in ("vec_id", "copy", "vector", "floor")]
                    + [pa.array([p for _, p in pairs], pa.int32())], names=["vec_id", "copy", "vector", "floor", "part"])
        rest = floored.mapInArrow(narrow, "vec_id long, copy long, vector array<double>, floor long, part int")
        found = near.unionByName(against(rest))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
