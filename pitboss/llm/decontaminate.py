"""Benchmark decontamination by spaced-seed hashing (operator 7).

A spaced seed is a fixed mask over consecutive tokens: only the tokens at its
marked positions are hashed, so a hit survives substitutions at the others.
All windows of the test items are hashed under every mask.  A bitmap of those
hashes (at most 2**MAX_BITS bits, whatever the benchmark's size) is broadcast;
it removes nearly all training windows inside the scan.  What passes is
joined with the test hashes, and every distinct alignment is verified token by
token around the hit.

Tokens are runs of letters and digits, lower-cased; other characters
separate.  An item of fewer tokens than the masks span is looked for as one
unbroken seed of its own length; items of fewer than MIN_TOKENS tokens are no
evidence and are not looked for.

Defined cases: null and empty texts match nothing; repeated items are
reported under each item_id; rows with a null doc_id are reported with a null
doc_id; a text repeated under several ids is reported for each; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of, map_batches, materialize
from .hashing import BYTES, Spans, mix, parts, text_bytes

# 1: the token is hashed, 0: it may differ.
MASKS = ("11101101011", "11011001111", "10110111011")
MIN_TOKENS = 5
MIN_BITS, MAX_BITS = 16, 27
SPARSE = 4096  # bits of the bitmap a test window
# Test windows that may be broadcast for the join; more are shuffled.
BROADCAST_WINDOWS = 500_000

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_rng = np.random.Generator(np.random.PCG64(7))
_SEATS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows and the rows' token offsets."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    letter = np.zeros(len(data) + 2, bool)
    letter[1:-1] = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter[1:-1] & (~letter[:-2] | edge[:-1]))
    ends = np.flatnonzero(letter[1:-1] & (~letter[2:] | edge[1:])) + 1
    return mix(Spans(data, BYTES).raw(starts, ends)), np.searchsorted(starts, offsets)


def _seeds(short: list[int]) -> list[tuple[int, ...]]:
    """Hashed offsets of every seed: the masks, then unbroken short ones."""
    return [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS] + [tuple(range(k)) for k in short]


def _span(seed: tuple[int, ...]) -> int:
    return seed[-1] + 1


def _windows(tokens: np.ndarray, seed: tuple[int, ...]) -> np.ndarray:
    n = len(tokens) - _span(seed) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, len(seed) * 64 + _span(seed), np.uint64)
    for k in seed:
        h += tokens[k:k + n] * _SEATS[k]
    return mix(h)


def _test_windows(items: DataFrame, short: list[int]) -> DataFrame:
    """(hash, item_id, item_key, at): all windows of all items under all seeds."""
    seeds, longest = _seeds(short), len(MASKS[0])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, offsets = tokens_of(*text_bytes(batch.column("text")))
        out = []
        for i in range(batch.num_rows):
            own = tokens[offsets[i]:offsets[i + 1]]
            for seed in seeds:
                if len(own) >= MIN_TOKENS and (len(own) >= longest or _span(seed) == len(own)):
                    h = _windows(own, seed)
                    out.append((h, np.full(len(h), i), np.arange(len(h))))
        h, row, at = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
        row = pa.array(row.astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(h.astype(np.uint64).view(np.int64)), batch.column("item_id").take(row),
             batch.column("item_key").take(row), pa.array(at.astype(np.int32))],
            names=["hash", "item_id", "item_key", "at"])
    return map_batches(items, run, "hash long, item_id long, item_key long, at int")


def _bitmap(test: DataFrame, windows: int) -> tuple[np.ndarray, int]:
    """Bits of the test hashes' leading bits, packed: SPARSE bits a window, so
    that few training windows pass by chance, up to 2**MAX_BITS."""
    bits = int(min(MAX_BITS, max(MIN_BITS, np.ceil(np.log2(SPARSE * max(1, windows))))))
    place = F.shiftrightunsigned("hash", 64 - bits)
    rows = (test.select(F.shiftright(place, 6).alias("word"),
                        F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 AS INT))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bit")).collect())  # at most 2**(MAX_BITS - 6) rows
    words = np.zeros(1 << (bits - 6), np.int64)
    for word, bit in rows:
        words[word] = bit
    return words.view(np.uint8), bits


def _marked(table: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Positions of the hashes whose bit is set."""
    place = (h >> np.uint64(64 - bits)).astype(np.int64)
    near = np.flatnonzero(table[place >> 3])
    place = place[near]
    return near[(table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]


SEGMENTS = "doc_id long, row_key long, start int, tokens binary, hashes array<long>, ats array<int>"


def _segments(docs: DataFrame, short: list[int], bitmap, bits: int, reach: int) -> DataFrame:
    """Stretches of documents around windows whose hash is in the bitmap: token
    hashes with ``reach`` tokens on both sides, and the windows."""
    seeds = _seeds(short)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        table = bitmap.value
        row_key = batch.column("row_key").to_pylist()
        doc_id = batch.column("doc_id").to_pylist()
        out = {k: [] for k in ("doc_id", "row_key", "start", "tokens", "hashes", "ats")}
        for a, b in parts(offsets):
            tokens, at = tokens_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            found, where = [], []
            for seed in seeds:
                h = _windows(tokens, seed)
                hit = _marked(table, h, bits)
                row = np.searchsorted(at, hit, "right") - 1
                hit = hit[hit + _span(seed) <= at[row + 1]]  # a window lies in one document
                found.append(h[hit])
                where.append(hit)
            h, hit = np.concatenate(found), np.concatenate(where)
            if not len(hit):
                continue
            order = np.argsort(hit, kind="stable")
            h, hit = h[order], hit[order]
            row = np.searchsorted(at, hit, "right") - 1
            cut = np.flatnonzero((np.diff(hit) > reach) | (np.diff(row) > 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(hit)], strict=True):
                r = row[lo]
                first, last = max(at[r], hit[lo] - reach), min(at[r + 1], hit[hi - 1] + 2 * reach)
                out["doc_id"].append(doc_id[a + r])
                out["row_key"].append(row_key[a + r])
                out["start"].append(int(first - at[r]))
                out["tokens"].append(tokens[first:last].tobytes())
                out["hashes"].append(h[lo:hi].view(np.int64))
                out["ats"].append((hit[lo:hi] - first).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(out["doc_id"], pa.int64()), pa.array(out["row_key"], pa.int64()),
             pa.array(out["start"], pa.int32()), pa.array(out["tokens"], pa.binary()),
             pa.array(out["hashes"], pa.list_(pa.int64())), pa.array(out["ats"], pa.list_(pa.int32()))],
            names=list(out))
    return map_batches(docs, run, SEGMENTS)


def _longest_stretch(match: np.ndarray, penalty: int) -> tuple[int, int]:
    """Start and end of the longest stretch, from a match to a match, in which at
    least penalty / (penalty + 1) of the tokens agree; (0, 0) if there is none."""
    score = np.concatenate([[0], np.cumsum(np.where(match, 1, -penalty))])
    low = np.minimum.accumulate(score)
    # first place whose score is not above the one at each end
    first = np.searchsorted(-low, -score, "left")
    end = int(np.argmax(np.arange(len(score)) - first))
    agree = np.flatnonzero(match[first[end]:end]) + first[end]
    return (int(agree[0]), int(agree[-1]) + 1) if len(agree) else (0, 0)


def _aligned(candidates: DataFrame, min_match: int, similarity: float) -> DataFrame:
    """Verify each alignment: (doc_id, item_id, start, end, matched, similarity, n_tokens)."""
    penalty = round(similarity / (1 - similarity))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, start, end, matched, share, size = [], [], [], [], [], []
        shift, first = batch.column("shift").to_pylist(), batch.column("start").to_pylist()
        own, n_own = tokens_of(*text_bytes(batch.column("text")))
        for i, blob in enumerate(batch.column("tokens")):
            tokens = np.frombuffer(blob.as_buffer(), np.uint64)
            item = own[n_own[i]:n_own[i + 1]]
            lo = max(0, shift[i])
            hi = min(len(tokens), shift[i] + len(item))
            match = tokens[lo:hi] == item[lo - shift[i]:hi - shift[i]]
            a, b = _longest_stretch(match, penalty)
            n = int(match[a:b].sum())
            if n >= min(min_match, max(1, int(np.ceil(similarity * len(item))))):
                keep.append(i)
                start.append(first[i] + lo + a)
                end.append(first[i] + lo + b)
                matched.append(n)
                share.append(n / (b - a))
                size.append(len(item))
        rows = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("item_id").take(rows), pa.array(start, pa.int64()),
             pa.array(end, pa.int64()), pa.array(matched, pa.int64()), pa.array(share, pa.float64()),
             pa.array(size, pa.int64())],
            names=["doc_id", "item_id", "first_token", "end_token", "matched", "similarity", "item_tokens"])
    return map_batches(candidates, run, "doc_id long, item_id long, first_token long, end_token long, matched long, "
                                        "similarity double, item_tokens long")


def overlaps(docs: DataFrame, items: DataFrame, min_match: int = 13, similarity: float = 0.8) -> DataFrame:
    """One row per document and test item that share a passage: a stretch of the
    same tokens at the same distances, of which at least ``similarity`` agree,
    with at least ``min_match`` agreeing tokens (or that share of a shorter
    item).  The longest stretch is reported, ties to the earliest."""
    spark = docs.sparkSession
    items = materialize(items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
        .withColumn("item_key", F.xxhash64("item_id", "text")).distinct())
    lengths = map_batches(items, lambda b: pa.RecordBatch.from_arrays(
        [pa.array(np.diff(tokens_of(*text_bytes(b.column("text")))[1]), pa.int64())], names=["n"]), "n long")
    longest = len(MASKS[0])
    stats = lengths.agg(F.max("n"), F.collect_set(F.when(F.col("n").between(MIN_TOKENS, longest - 1), F.col("n"))),
                        F.sum(F.greatest(F.col("n") - longest + 1, F.lit(1)))).first()
    reach, short, windows = stats[0] or 1, sorted(stats[1] or []), (stats[2] or 0) * len(MASKS)
    test = materialize(_test_windows(items, short))
    table, bits = _bitmap(test, windows)
    bitmap = spark.sparkContext.broadcast(table)
    texts = documents_of(docs).select("doc_id", F.lower("text").alias("text"))
    texts = texts.withColumn("row_key", F.xxhash64("doc_id", "text"))
    segments = materialize(_segments(texts, short, bitmap, bits, reach))
    hits = segments.select("doc_id", "row_key", "start", F.explode(F.arrays_zip("hashes", "ats")).alias("hit"))
    hits = hits.select("doc_id", "row_key", "start", "hit.hashes", "hit.ats")
    side = F.broadcast(test) if windows <= BROADCAST_WINDOWS else test
    shifts = (hits.join(side, hits["hashes"] == side["hash"])
              .select("doc_id", "row_key", "start", "item_key", (F.col("ats") - F.col("at")).alias("shift"))
              .distinct())
    text_of = items.select(F.col("item_key").alias("__item"), "item_id", "text")
    keys = ["doc_id", "row_key", "start"]
    found = (shifts.withColumnsRenamed({k: f"__{k}" for k in keys})
             .join(segments.dropDuplicates(keys),
                   F.expr("__doc_id <=> doc_id AND __row_key = row_key AND __start = start"))
             .join(text_of, F.col("item_key") == F.col("__item"))
             .select("doc_id", "item_id", "start", "tokens", "shift", "text"))
    best = (F.struct(F.col("matched"), (-F.col("first_token")).alias("first"), F.col("end_token"),
                     F.col("similarity"), F.col("item_tokens")))
    return (_aligned(found, min_match, similarity).groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
            .select("doc_id", "item_id", (-F.col("best.first")).alias("first_token"), "best.end_token",
                    "best.matched", "best.similarity", "best.item_tokens"))
