"""Suffix-array deduplication by distributed prefix doubling (operator 1).

Removes every byte covered by a string of ``threshold`` bytes that also
starts in a document with a smaller doc_id.

Positions get names (ranks up to renaming): the name of the 2k bytes at a
position is made of the pair of names at the position and k further on, from
8 bytes up, the last pair overlapping so that it ends at the wanted length.  After
each round all chunks' names meet, sorted, in buckets; positions whose name no
other document has are unique and drop out, the others go on:

1. SAMPLE bytes.  Of a threshold-long window only its least name of that length
   is sorted (equal windows have equal least names), which stands for the whole
   run of windows that share it: about one name in fourteen positions.
   Windows whose least name is in no document with a smaller doc_id end here.
2. Runs.  The string that a run of such windows covers is named as a whole.
   If a smaller document has the whole run, so are all its windows.
3. ``threshold`` bytes.  The windows of runs whose least name occurs in
   different runs (where copies begin, end or differ) are ranked one by one.

Documents are dealt to chunks by ranges of doc_id, so a chunk's number orders
its documents before those of the next, and an answer is one byte a name.
Names have 64 bits; a match in rounds 2 and 3 takes two of them (113 bits).

Defined cases: null and empty texts lose nothing; rows with a null doc_id
lose nothing and take nothing from others; rows that share a doc_id do not
take from each other; texts shorter than the threshold are left whole; other
columns are ignored.  ``kept`` may begin or end inside a character.
"""

from __future__ import annotations

import hashlib
import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange
from .common import documents_of, map_batches, materialize, small_batches
from .hashing import Spans, mix, text_bytes

CHUNK_BYTES = 2 << 20
# Bytes of the names of round 1.  Longer ones are rarer by chance (less work in
# round 3) but there are more of them (round 1).
SAMPLE = 24
SMALLER, LARGER = 1, 2  # bits of the first answers
OPEN = 2


# Positions named at a time: the temporary arrays stay in the processor's cache.
BLOCK = 1 << 16


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Name of the pair of two names."""
    name = first * np.uint64(0x9E3779B97F4A7C15)
    name += second
    name ^= name >> np.uint64(32)
    name *= np.uint64(0xD6E8FEB86659FD93)
    return name


def names(data: np.ndarray, size: int) -> np.ndarray:
    """Name of the ``size`` bytes (8 or more) at every position that has them."""
    name = data.astype(np.uint64)
    width = 1
    while width < 8:  # up to eight bytes the bytes are the name
        name = name[:max(0, len(name) - width)] | (name[width:] << np.uint64(8 * width))
        width *= 2
    while width < size:  # twice as long, or to the end with an overlap
        step = min(width, size - width)
        name = _pair(name[:max(0, len(name) - step)], name[step:])
        width += step
    name ^= name >> np.uint64(29)
    return name


def least_names(data: np.ndarray, threshold: int) -> np.ndarray:
    """For every window of ``threshold`` bytes the least name of a string of SAMPLE bytes inside it."""
    out = np.empty(max(0, len(data) - threshold + 1), np.uint64)
    for at in range(0, len(out), BLOCK):
        least, width, reach = names(data[at:at + BLOCK + threshold - 1], SAMPLE), 1, threshold - SAMPLE + 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[:len(least) - reach + width], least[reach - width:])
        out[at:at + BLOCK] = least
    return out


class Chunk:
    """One chunk's documents by doc_id, and the runs of their windows."""

    def __init__(self, rows: pa.Table, threshold: int):
        rows = rows.sort_by("doc_id")
        self.rows = rows
        self.number = rows.column("chunk")[0].as_py()
        self.doc_id = rows.column("doc_id").to_numpy()
        self.data, self.offsets = text_bytes(rows.column("text"))
        # order of the chunk's documents; equal ids are equal
        self.rank = np.unique(self.doc_id, return_inverse=True)[1]
        self.threshold = threshold
        self.start = self.end = self.run_rank = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        # windows: none begins in the last bytes of a document
        least = least_names(self.data, threshold)
        if not len(least):
            return
        valid = np.zeros(len(least) + threshold + 1, np.int8)
        some = np.diff(self.offsets) >= threshold
        valid[self.offsets[:-1][some]] = 1
        valid[self.offsets[1:][some] - threshold + 1] -= 1
        valid = np.cumsum(valid[:len(least)], dtype=np.int8).view(bool)
        change = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=change[1:])
        # a run begins where the name changes or windows begin, and ends before the next change or gap
        begin = valid.copy()
        begin[1:] &= change[1:] | ~valid[:-1]
        last = valid.copy()
        last[:-1] &= change[1:] | ~valid[1:]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1  # behind the last window of each run
        self.key = least[self.start]
        self.run_rank = self.rank[np.searchsorted(self.offsets, self.start, "right") - 1]

    @cached_property
    def spans(self) -> Spans:
        return Spans(self.data)

    def content(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Names of the strings of ``size`` bytes at positions."""
        return mix(self.spans.raw(at, at + size) + np.asarray(size).astype(np.uint64))


def _lowest(group: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each of n groups."""
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(low, group, value)
    np.maximum.at(high, group, value)
    return low, high


def _first_names(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(c.key, return_inverse=True)


def _first_answer(number: np.ndarray, facts: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    low, high = _lowest(number, chunk, int(number.max()) + 1)
    return ((chunk > low[number]) * SMALLER + (chunk < high[number]) * LARGER).astype(np.uint8)


def _shared_runs(c: Chunk, first: np.ndarray, threshold: int) -> np.ndarray:
    """Runs whose least name some other document has."""
    keys, of = _first_names(c)
    low, high = _lowest(of, c.run_rank, len(keys))
    return np.flatnonzero((first[of] > 0) | (high > low)[of])


def _entries(key: np.ndarray, name: np.ndarray, rank: np.ndarray):
    """Distinct (key, name) in order: keys, names, each row's entry, least rank of each entry."""
    order = np.lexsort((name, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (name[order][1:] != name[order][:-1])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    one = order[new]
    return key[one], name[one], of, _lowest(of, rank, len(one))[0]


def _run_entries(c: Chunk, runs: np.ndarray, threshold: int):
    size = (c.end - c.start)[runs] + threshold - 1
    return _entries(c.key[runs], c.content(c.start[runs], size), c.run_rank[runs])


def _second_answer(number: np.ndarray, name: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """1: a smaller chunk has the run; OPEN: the key stands for different runs."""
    order = np.lexsort((name, number))
    n, r = number[order], name[order]
    new = np.ones(len(order), bool)
    new[1:] = (n[1:] != n[:-1]) | (r[1:] != r[:-1])
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(new) - 1
    low = _lowest(run, chunk, int(new.sum()))[0]
    kinds = np.bincount(n[new], minlength=int(number.max()) + 1)
    return ((chunk > low[run]) + OPEN * (kinds[number] > 1)).astype(np.uint8)


def _third_answer(number: np.ndarray, name: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    return _second_answer(number, name, chunk) & 1


def _settled_runs(c: Chunk, first: np.ndarray, second: np.ndarray, threshold: int):
    """(runs that a smaller document has, open runs)."""
    runs = _shared_runs(c, first, threshold)
    _, _, of, low = _run_entries(c, runs, threshold)
    copied = ((second[of] & 1) > 0) | (c.run_rank[runs] > low[of])
    return runs[copied], runs[~copied & ((second[of] & OPEN) > 0)]


def _open_windows(c: Chunk, runs: np.ndarray, threshold: int):
    length = (c.end - c.start)[runs]
    at = np.repeat(c.start[runs] - np.cumsum(length) + length, length) + np.arange(length.sum())
    run = np.repeat(runs, length)
    return at, _entries(c.key[run], c.content(at, threshold), c.run_rank[run]), c.run_rank[run]


def _round(rows: pa.Table, k: int, dtype: str = "u1") -> np.ndarray:
    return exchange.answers_in_order(rows.filter(pa.compute.equal(rows.column("round"), k)), dtype)


def copied_bytes(c: Chunk, answers: pa.Table, threshold: int) -> np.ndarray:
    """Which bytes of the chunk are covered by a copied window."""
    cover = np.zeros(len(c.data) + 1, np.int32)
    if len(c.start):
        copied, open_ = _settled_runs(c, _round(answers, 1), _round(answers, 2), threshold)
        np.add.at(cover, c.start[copied], 1)
        np.subtract.at(cover, c.end[copied] + threshold - 1, 1)
        at, (_, _, of, low), rank = _open_windows(c, open_, threshold)
        if len(at):
            at = at[(_round(answers, 3)[of] > 0) | (rank > low[of])]
            np.add.at(cover, at, 1)
            np.subtract.at(cover, at + threshold, 1)
    return np.cumsum(cover[:-1]) > 0


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _results(rows: pa.Table | pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, gone: np.ndarray,
             with_text: bool) -> pa.Table:
    removed, spans, digests, kept_texts = [], [], [], []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = gone[a:b]
        n = int(own.sum())
        kept = data[a:b].tobytes() if not n else data[a:b][~own].tobytes()
        removed.append(n)
        spans.append(int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if n else 0)
        digests.append(hashlib.sha256(kept).hexdigest())
        if with_text:
            kept_texts.append(kept)
    out = {"doc_id": rows.column("doc_id"), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
           "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
           "kept_sha256": pa.array(digests, pa.string())}
    if with_text:
        out |= {"text_hash": rows.column("text_hash"), "kept": pa.array(kept_texts, pa.binary())}
    return pa.table(out)


def suffix_dedup(docs: DataFrame, threshold: int = 50, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document; with
    ``with_text`` also (text_hash, kept binary): xxhash64 of the text and what is left of it."""
    if threshold < SAMPLE:
        raise ValueError(f"threshold must be at least {SAMPLE} bytes")
    spark = docs.sparkSession
    small_batches(spark)
    texts = documents_of(docs)
    columns = ["doc_id", "text"]
    if with_text:
        texts, columns = texts.withColumn("text_hash", F.xxhash64("text")), [*columns, "text_hash"]
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(math.ceil(total / CHUNK_BYTES), spark.sparkContext.defaultParallelism)
    bits = max(3, math.ceil(math.log2(n)) - 1)
    placed = materialize(texts.where("doc_id is not null").repartitionByRange(n, "doc_id")
                         .select(F.spark_partition_id().alias("chunk"), *columns))

    def asked(keys_of, answers):
        def run(rows: pa.Table, known: pa.Table) -> pa.Table:
            keys, facts = keys_of(Chunk(rows, threshold), known)
            return exchange.blobs_of(keys, facts, rows.column("chunk")[0].as_py(), bits)
        return exchange.apply_answers(placed, answers, run, exchange.ASKED)

    def kept_answers(asked_: DataFrame, fact: str, respond, k: int) -> DataFrame:
        return materialize(exchange.answer(asked_, fact, respond).withColumn("round", F.lit(k)))

    def round_1(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys = _first_names(Chunk(rows, threshold))[0]
        return keys, np.zeros(0, np.uint8)

    def round_2(c: Chunk, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _run_entries(c, _shared_runs(c, _round(known, 1), threshold), threshold)[:2]

    def round_3(c: Chunk, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        open_ = _settled_runs(c, _round(known, 1), _round(known, 2), threshold)[1]
        return _open_windows(c, open_, threshold)[1][:2]

    def finish(rows: pa.Table, known: pa.Table) -> pa.Table:
        c = Chunk(rows, threshold)
        return _results(c.rows, c.data, c.offsets, copied_bytes(c, known, threshold), with_text)

    first = kept_answers(exchange.ask(placed, bits, round_1), "u1", _first_answer, 1)
    second = kept_answers(asked(round_2, first), "u8", _second_answer, 2)
    both = first.union(second)
    third = kept_answers(asked(round_3, both), "u8", _third_answer, 3)
    schema = RESULT + (", text_hash long, kept binary" if with_text else "")
    out = exchange.apply_answers(placed, both.union(third), finish, schema)

    def untouched(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        return _results(batch, data, offsets, np.zeros(len(data), bool), with_text).to_batches()[0]
    return out.union(map_batches(texts.where("doc_id is null"), untouched, schema))
