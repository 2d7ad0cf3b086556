"""Ask and answer: statistics of keys over the whole corpus, packed in blobs.

Documents are dealt to chunks of a few megabytes.  A chunk asks about its
distinct keys (64-bit hashes): they are dealt to buckets by their leading
bits, each chunk's part packed into one binary value.  A bucket sees every
chunk that holds a key and answers with one value a key, in the order asked.
Keys repeat neither within a chunk nor in an answer, so a key that a third of
all documents hold arrives once a chunk, and no row is made for a position.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

CHUNK_BYTES = 6 << 20
KEY_BYTES = 5
ASKED = "bucket int, chunk int, keys binary, facts binary"


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text) and the bits of a bucket number.

    One pass over the lengths sizes the chunks; a row's chunk follows from its
    content, so a repeated computation deals it to the same one."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(math.ceil(total / chunk_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    small_batches(docs.sparkSession)
    return (docs.select(F.pmod(F.xxhash64("doc_id", F.crc32("text")), F.lit(n)).cast("int").alias("chunk"),
                        "doc_id", "text"), max(3, math.ceil(math.log2(n))))


def _pack(keys: np.ndarray, bits: int) -> bytes:
    """The leading KEY_BYTES bytes of keys after their bucket's bits."""
    short = (keys << np.uint64(bits)) >> np.uint64(64 - 8 * KEY_BYTES)
    return short.reshape(-1, 1).view(np.uint8)[:, :KEY_BYTES].tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, KEY_BYTES)
    return out.view(np.uint64).ravel()


def ask(chunks: DataFrame, bits: int, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(bucket, chunk, keys, facts): ``keys_of(chunk's rows)`` gives 64-bit keys in
    ascending order and one fact (fixed-width number) a key."""
    def run(rows: pa.Table) -> pa.Table:
        return blobs_of(*keys_of(rows), rows.column("chunk")[0].as_py(), bits)
    return chunks.groupBy("chunk").applyInArrow(run, ASKED)


def blobs_of(keys: np.ndarray, facts: np.ndarray, chunk: int, bits: int) -> pa.Table:
    """The rows of ``ask`` for one chunk."""
    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    full = [i for i in range(1 << bits) if cuts[i] < cuts[i + 1]]
    return pa.table({
        "bucket": pa.array(full, pa.int32()), "chunk": pa.array([chunk] * len(full), pa.int32()),
        "keys": pa.array([_pack(keys[cuts[i]:cuts[i + 1]], bits) for i in full], pa.binary()),
        "facts": pa.array([facts[cuts[i]:cuts[i + 1]].tobytes() for i in full], pa.binary())})


def answer(asked: DataFrame, fact: str,
           respond: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(chunk, bucket, answers): ``respond(key number, fact, chunk)`` of all
    entries of a bucket gives one value an entry."""
    def run(rows: pa.Table) -> pa.Table:
        blobs = rows.column("keys").to_pylist()
        keys = np.concatenate([_unpack(b) for b in blobs])
        facts = np.concatenate([np.frombuffer(b, fact) for b in rows.column("facts").to_pylist()])
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        number = np.empty(len(keys), np.int64)
        number[order] = np.cumsum(new) - 1
        del keys, order, new
        chunk = np.repeat(rows.column("chunk").to_numpy(), [len(b) // KEY_BYTES for b in blobs])
        out = respond(number, facts, chunk)
        cuts = np.concatenate([[0], np.cumsum([len(b) // KEY_BYTES for b in blobs])])
        return pa.table({
            "chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
            "answers": pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})
    return asked.groupBy("bucket").applyInArrow(run, "chunk int, bucket int, answers binary")


def answers_in_order(rows: pa.Table, dtype: str) -> np.ndarray:
    """A chunk's answers in the order of its sorted keys."""
    order = np.argsort(rows.column("bucket").to_numpy(), kind="stable")
    blobs = rows.column("answers").to_pylist()
    return np.concatenate([np.frombuffer(blobs[i], dtype) for i in order]) if blobs else np.zeros(0, dtype)


def apply_answers(chunks: DataFrame, answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table],
                  schema: str) -> DataFrame:
    """``fn(chunk's rows, chunk's answers)`` for every chunk."""
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(fn, schema)
