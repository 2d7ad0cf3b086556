"""N-gram Jaccard join with set-relation skipping (operator 2).

Links two documents when the Jaccard similarity of their sets of word
5-shingles is at least 75 %, exactly.

* Shingle counts over all documents come from ``exchange``: a set can only
  link when at least 75 % of its shingles occur in another set, and sets are
  indexed by their rarest shingles first (prefix filter).
* Equal sets become one node (the smallest doc_id with the set).
* Index-level skipping: an index list (the nodes that hold a shingle in their
  prefix) is ordered by set size; for each node the block of sizes that can
  link is found by binary search and the rest skipped; within it, positions
  bound the overlap that is still possible.
* Answer-level skipping: the first rounds verify every list against one leader.
  A node keeps its exact distance (size of the symmetric difference) to its
  home, the nearest leader; from then on the distance of two nodes with the
  same home is bounded from both sides by these answers (it is a metric), so
  most pairs are linked or dismissed without computing an overlap.  Pairs
  whose ends are connected already are skipped as well: only connectivity is
  returned.

Hashes of shingles have 64 bits; two different shingles of one pair of sets
that share a hash would count as equal.  The counts only order the index and
use 40 bits and the bucket number.

Defined cases: null, empty or blank texts have an empty set, link with
nothing and are their own component; rows with a null doc_id link with
nothing and have a null component; repeated rows are returned as often as
they occur; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange
from .common import by_size, documents_of, map_batches, materialize, small_batches
from .graph import components
from .hashing import mix, shingle_sets


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap with any set that links with one of size n."""
    return -(-n * percent // 100)


def _max_distance(total: np.ndarray, percent: int) -> np.ndarray:
    """Largest symmetric difference of linked sets whose sizes sum to total."""
    return total * (100 - percent) // (100 + percent)


def _keys_of(size: int):
    def run(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, hashes = shingle_sets(rows.column("text"), size)
        keys, count = np.unique(hashes, return_counts=True)
        return keys, np.minimum(count, 65535).astype(np.uint16)
    return run


def _rarity(number: np.ndarray, count: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """0 for a shingle of one set, else a class that grows with its count."""
    total = np.bincount(number, weights=count)
    level = np.minimum(255, 1 + 8 * np.log2(np.maximum(total, 1)))
    return np.where(total < 2, 0, level).astype(np.uint8)[number]


# Leader rounds before all pairs that are still open: which leader a list has.
ROUNDS = (False, True)
# Index entries of one bucket: bounds a task's memory.  A pair is found in every
# bucket that holds one of its shared shingles, so there should be few buckets.
BUCKET_ENTRIES = 1 << 20
# What one task writes: bytes of sets; pairs that it verifies.
TASK_BYTES = 4 << 20
TASK_PAIRS = 1 << 12
SETS = "doc_id long, n long, set_key long, tokens binary"


def _sets_of(size: int, percent: int):
    """Per document its set's size, key and, if it can link, its shared
    shingles, rarest first."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        counts, hashes = shingle_sets(rows.column("text"), size)
        keys, number = np.unique(hashes, return_inverse=True)
        level = exchange.answers_in_order(answers, "u1")[number]
        ends = np.cumsum(counts)
        starts = ends - counts
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
        set_key = (sums[ends] - sums[starts]).view(np.int64)
        shared = np.concatenate([[0], np.cumsum(level > 0)])
        shared = shared[ends] - shared[starts]
        live = (counts > 0) & (shared >= _least_overlap(counts, percent))
        tokens = []
        for i in range(len(counts)):
            if not live[i]:
                tokens.append(None)
                continue
            h, c = hashes[starts[i]:ends[i]], level[starts[i]:ends[i]]
            h, c = h[c > 0], c[c > 0]
            tokens.append(h[np.argsort(c, kind="stable")].tobytes())  # ties in hash order
        return pa.table({"doc_id": rows.column("doc_id"), "n": pa.array(counts, pa.int64()),
                         "set_key": pa.array(set_key, mask=counts == 0), "tokens": pa.array(tokens, pa.binary())})
    return run


def _postings(nodes: DataFrame, bits: int, percent: int) -> DataFrame:
    """Index entries of the nodes' prefixes, packed by bucket of the shingle."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {k: [] for k in ("token", "node", "n", "at", "home", "far", "label")}
        columns = {k: batch.column(k).to_pylist() for k in ("node", "n", "home", "far", "label")}
        for i, blob in enumerate(batch.column("tokens")):
            tokens, n = np.frombuffer(blob.as_buffer(), np.uint64), columns["n"][i]
            alone = n - len(tokens)  # shingles of this set only: they come first
            tokens = tokens[:max(0, n - int(_least_overlap(np.int64(n), percent)) + 1 - alone)]
            out["token"].append(tokens)
            out["at"].append(np.arange(alone, alone + len(tokens)))
            for k, v in columns.items():
                out[k].append(np.full(len(tokens), v[i], np.int64))
        out = {k: np.concatenate(v) for k, v in out.items()}
        bucket = (out["token"] >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        pieces = np.split(order, cuts[1:]) if len(order) else []
        return pa.RecordBatch.from_arrays(
            [pa.array([int(bucket[p[0]]) for p in pieces], pa.int32()),
             *[pa.array([out[k][p].tobytes() for p in pieces], pa.binary()) for k in out]],
            names=["bucket", *out])
    return map_batches(nodes, run, "bucket int, token binary, node binary, n binary, at binary, home binary, "
                                   "far binary, label binary")


def _lists(rows: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """A bucket's index entries ordered by (shingle, size, node), and the lists' starts."""
    out = {k: np.concatenate([np.frombuffer(b, np.uint64 if k == "token" else np.int64)
                              for b in rows.column(k).to_pylist()]) for k in rows.column_names if k != "bucket"}
    order = np.lexsort((out["node"], out["n"], out["token"]))
    out = {k: v[order] for k, v in out.items()}
    starts = np.flatnonzero(np.concatenate([[True], out["token"][1:] != out["token"][:-1]]))
    return out, np.append(starts, len(order))


def _leader_pairs(percent: int, nearest: bool):
    """Every list's nodes against one leader: the least mixed node number, or
    with ``nearest`` the node nearest to its home, which in a group of copies
    edited independently is close to all of them."""
    def run(rows: pa.Table) -> pa.Table:
        e, cuts = _lists(rows)
        pairs, linked = [], []
        rank = mix(e["node"].view(np.uint64).copy())
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            label = e["label"][a:b]
            if b - a < 2 or (label == label[0]).all():
                continue
            n, node, home, far = (e[k][a:b] for k in ("n", "node", "home", "far"))
            if nearest:
                lead = int(np.argmin(np.where((home >= 0) & (home != node), far, np.iinfo(np.int64).max)))
                if home[lead] < 0 or home[lead] == node[lead]:
                    continue
            else:
                lead = int(np.argmin(rank[a:b]))
            lo, hi = np.searchsorted(n, (_least_overlap(n[lead], percent), n[lead] * 100 // percent + 1))  # block skip by size
            j = np.arange(lo, hi)
            j = j[label[j] != label[lead]]
            limit = _max_distance(n[lead] + n[j], percent)
            same = (home[j] == home[lead]) & (home[lead] >= 0)
            j, same, limit = (x[~same | (np.abs(far[j] - far[lead]) <= limit)] for x in (j, same, limit))
            pairs.append(np.stack([np.full(len(j), node[lead]), node[j]]))
            linked.append(same & (far[j] + far[lead] <= limit))
        return _pair_table(pairs, linked)
    return run


def _pair_table(pairs: list[np.ndarray], linked: list[np.ndarray]) -> pa.Table:
    pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    done = np.concatenate(linked) if linked else np.zeros(0, bool)
    order = np.lexsort((pairs[1], pairs[0]))
    pairs, done = pairs[:, order], done[order]
    new = np.ones(len(order), bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
    return pa.table({"a": pa.array(pairs[0][new], pa.int64()), "b": pa.array(pairs[1][new], pa.int64()),
                     "linked": pa.array(done[new], pa.bool_())})


def _rest_pairs(percent: int):
    """Pairs of a list that are not connected yet and that answers so far leave open."""
    def run(rows: pa.Table) -> pa.Table:
        e, cuts = _lists(rows)
        pairs, linked = [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            label = e["label"][a:b]
            if b - a < 2 or (label == label[0]).all():
                continue
            n, at, node, home, far = (e[k][a:b] for k in ("n", "at", "node", "home", "far"))
            for i in range(b - a - 1):
                hi = int(np.searchsorted(n, n[i] * 100 // percent, "right"))  # block skip by size
                j = np.arange(i + 1, hi)
                j = j[label[j] != label[i]]
                if not len(j):
                    continue
                total = n[i] + n[j]
                limit = _max_distance(total, percent)
                # positions: what can still be shared from this shingle on
                open_ = total - 2 * np.minimum(n[i] - at[i], n[j] - at[j]) <= limit
                same = (home[j] == home[i]) & (home[i] >= 0)
                open_ &= ~same | (np.abs(far[j] - far[i]) <= limit)
                open_ &= ~((home[j] == node[i]) | (home[i] == node[j]))  # verified in round one
                j, same, limit = j[open_], same[open_], limit[open_]
                pairs.append(np.stack([np.full(len(j), node[i]), node[j]]))
                linked.append(same & (far[j] + far[i] <= limit))
        return _pair_table(pairs, linked)
    return run


PAIRS = "a long, b long, linked boolean"


def _verify(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, far, linked): exact distance of each pair."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        far, linked = [], []
        for ta, tb, na, nb in zip(batch.column("ta"), batch.column("tb"), batch.column("na").to_pylist(),
                                  batch.column("nb").to_pylist(), strict=True):
            x, y = (np.frombuffer(t.as_buffer(), np.uint64) for t in (ta, tb))
            both = np.sort(np.concatenate([x, y]))
            overlap = int((both[1:] == both[:-1]).sum())
            far.append(na + nb - 2 * overlap)
            linked.append(100 * overlap >= percent * (na + nb - overlap))
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far, pa.int64()),
                                           pa.array(linked, pa.bool_())], names=["a", "b", "far", "linked"])
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return map_batches(pairs.select("a", "b").join(left, "a").join(right, "b"), run,
                       "a long, b long, far long, linked boolean")


def _placed(nodes: DataFrame, home: DataFrame | None, links: DataFrame | None) -> DataFrame:
    """``nodes`` with what is known of them: home, distance to it, component so far."""
    if home is None:
        return nodes.select("*", F.lit(-1).cast("long").alias("home"), F.lit(0).cast("long").alias("far"),
                            F.col("node").alias("label"))
    labels = components(links).withColumnRenamed("node", "__label_node")
    home = home.withColumnRenamed("node", "__home_node")
    return (nodes.join(home, nodes["node"] == home["__home_node"], "left")
            .join(labels, nodes["node"] == labels["__label_node"], "left")
            .select("node", "n", "tokens", F.coalesce("home", F.lit(-1).cast("long")).alias("home"),
                    F.coalesce("far", F.lit(0).cast("long")).alias("far"),
                    F.coalesce("label", "node").alias("label")))


def jaccard_join(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_id): set_id is the smallest doc_id
    with an equal set, component_id the smallest reachable by links."""
    small_batches(docs.sparkSession)
    chunks, bits = exchange.chunked(documents_of(docs))
    answers = exchange.answer(exchange.ask(chunks, bits, _keys_of(size)), "u2", _rarity)
    sets = materialize(exchange.apply_answers(chunks, answers, _sets_of(size, percent), SETS))
    known = sets.where("doc_id is not null and set_key is not null")
    n_known, live_bytes = known.agg(F.count("*"), F.sum(F.octet_length("tokens"))).first()
    classes = materialize(by_size(known.groupBy("set_key").agg(F.min("doc_id").alias("node")), n_known))
    # one row of each set that can link: the equal sets' tokens are equal
    first = known.where("tokens is not null").join(
        classes.withColumnRenamed("set_key", "__key"),
        (F.col("set_key") == F.col("__key")) & (F.col("doc_id") == F.col("node")))
    nodes = materialize(by_size(first.dropDuplicates(["node"]).select("node", "n", "tokens"),
                                live_bytes or 0, TASK_BYTES))

    entries, n_nodes = nodes.agg(F.sum(F.octet_length("tokens") / 8), F.count("*")).first()
    entries = entries or 0
    bits = max(3, math.ceil(math.log2(max(1, entries * (100 - percent) / 100 / BUCKET_ENTRIES))))
    home = None  # (node, far, home) of the nodes verified so far: the nearest leader, itself for a leader
    links = None
    for nearest in ROUNDS:
        lists = _postings(_placed(nodes, home, links), bits, percent)
        pairs = materialize(lists.groupBy("bucket").applyInArrow(_leader_pairs(percent, nearest), PAIRS)
                            .groupBy("a", "b").agg(F.max("linked").alias("linked")))
        open_ = pairs.where("not linked")
        tested = materialize(by_size(_verify(open_, nodes, percent), open_.count(), TASK_PAIRS))
        new = tested.where("linked").select("a", "b").union(pairs.where("linked").select("a", "b"))
        links = new if links is None else links.union(new)
        near = (tested.select(F.col("b").alias("node"), "far", F.col("a").alias("home"))
                .unionByName(tested.select(F.col("a").alias("node"), F.lit(0).cast("long").alias("far"),
                                           F.col("a").alias("home"))))
        near = near if home is None else near.unionByName(home)
        home = materialize(by_size(near.groupBy("node").agg(F.min(F.struct("far", "home")).alias("best"))
                                   .select("node", "best.far", "best.home"), n_nodes))
    rest = materialize(_postings(_placed(nodes, home, links), bits, percent).groupBy("bucket")
                       .applyInArrow(_rest_pairs(percent), PAIRS).groupBy("a", "b")
                       .agg(F.max("linked").alias("linked")))
    open_ = rest.where("not linked")
    more = materialize(by_size(_verify(open_, nodes, percent), open_.count(), TASK_PAIRS)).where("linked").select("a", "b")
    more = more.union(rest.where("linked").select("a", "b"))
    found = components(links.union(more))
    member = (classes.join(found.withColumnRenamed("node", "__node"), classes["node"] == F.col("__node"), "left")
              .select(F.col("set_key").alias("__set"), F.col("node").alias("set_id"),
                      F.coalesce("label", "node").alias("component_id")))
    return (sets.select("doc_id", "n", "set_key").join(member, sets["set_key"] == member["__set"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("set_id", "doc_id")).alias("set_id")))
