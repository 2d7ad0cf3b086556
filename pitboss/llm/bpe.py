"""Byte-level BPE encoding and decoding (operator 9).

Encoding: every text is cut by the public pre-token pattern; the distinct
pieces of an Arrow batch are encoded by the ``tokenizers`` library, and the
ids and bytes of each word are kept in a bounded per-worker table, so that a
frequent word is encoded once.  Byte-level BPE works on a printable
alphabet: each of the 256 byte values has one character (``byte_alphabet``).
Decoding reverses that table; a character whose bytes are split over several
tokens is put together again because the bytes, not the characters, of the
tokens are joined.

Defined cases: null and empty texts have no tokens; a text may be of any
length (it is cut into pieces, each encoded whole); repeated rows give
repeated results; other columns are ignored.  Special-token strings are
ordinary text.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of, map_batches

# A worker forgets its table of encoded words beyond this many entries.
CACHE_WORDS = 300_000


def byte_alphabet() -> list[str]:
    """The printable character standing for each byte value in byte-level BPE.

    Printable Latin-1 characters stand for themselves, the other values take
    the code points from 256 on, in order.
    """
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(extra)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _merges(ranks: dict[bytes, int], spell) -> list[tuple[str, str]]:
    """The merge list of a rank file: every token's split into the two parts
    that the lower ranks alone build, in rank order."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) < 2:
            continue
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank)
                       if parts[i] + parts[i + 1] != token else rank)
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            merges.append((spell(parts[0]), spell(parts[1])))
    return merges


# A lone space between two characters that are surely not white space starts a
# piece in the public pattern, so a text may be cut there before the pattern
# is applied: the pieces are the same and the table can hold whole words.
WORD_CUT = re.compile("(?<=[!-~\u00a1-\u167f]) (?=[!-~\u00a1-\u167f])")


@dataclass
class Codec:
    tokenizer: object
    token_bytes: list[bytes]
    decimal: list[str]
    starts_word: np.ndarray
    words: dict


@lru_cache(maxsize=4)
def codec(rank_path: str, pattern: str) -> Codec:
    """The tokenizer built from a rank file (one per worker and file)."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(rank_path)
    alphabet = byte_alphabet()
    spell = lambda token: "".join(alphabet[b] for b in token)
    vocab = {spell(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=_merges(ranks, spell)))
    # the library maps bytes to characters after the cut and keeps the offsets
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    token_bytes = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        token_bytes[rank] = token
    starts_word = np.array([t.startswith(b" ") for t in token_bytes])
    return Codec(tokenizer, token_bytes, [str(i) for i in range(len(token_bytes))], starts_word, {})


def encode_batch(c: Codec, texts: list[str]) -> list[list[int]]:
    """Token ids of each text."""
    return [e.ids for e in c.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _entry(c: Codec, ids: list[int]) -> tuple[str, int, bytes]:
    return " ".join([c.decimal[i] for i in ids]), len(ids), decode(c, ids)


def _learn(c: Codec, words: list[str]) -> None:
    """Encode words that the table lacks, each with its leading space.

    Words without an inner space are encoded as one text: exactly the first
    token of each then begins with a space.
    """
    plain = [w for w in words if " " not in w]
    for k in range(0, len(plain), 5000):
        part = plain[k:k + 5000]
        ids = encode_batch(c, [" " + " ".join(part)])[0]
        cuts = np.flatnonzero(c.starts_word[ids]).tolist() + [len(ids)]
        if len(cuts) != len(part) + 1:
            raise AssertionError("words and tokens disagree")
        for word, a, b in zip(part, cuts[:-1], cuts[1:], strict=True):
            c.words[word] = _entry(c, ids[a:b])
    rest = [w for w in words if " " in w]
    for word, ids in zip(rest, encode_batch(c, [" " + w for w in rest]), strict=True):
        c.words[word] = _entry(c, ids)


def encode_words(c: Codec, texts: list[str]) -> list[list[tuple[str, int, bytes]]]:
    """Per text its words' (decimal ids, number of ids, decoded bytes); the
    first word of a text has no leading space and is not kept in the table."""
    gc.disable()  # the table's many small objects hold no cycles; scanning them costs a third of the time
    cut = [WORD_CUT.split(t) for t in texts]
    first = [_entry(c, ids) for ids in encode_batch(c, [words[0] for words in cut])]
    known = c.words
    missing = {w for words in cut for w in words[1:] if w not in known}
    if len(known) + len(missing) > CACHE_WORDS:
        known.clear()
        missing = {w for words in cut for w in words[1:]}
    _learn(c, list(missing))
    return [[head, *[known[w] for w in words[1:]]] for head, words in zip(first, cut, strict=True)]


def decode(c: Codec, ids: list[int]) -> bytes:
    """The bytes of the ids; unknown ids raise IndexError."""
    return b"".join([c.token_bytes[i] for i in ids])


def _worker_path(path: str) -> str:
    return SparkFiles.get(path[len("files:"):]) if path.startswith("files:") else path


def encode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>, starts array<int>, ends array<int>) of every text.

    ``rank_path`` is read by each worker: a file installed on every machine,
    or ``files:NAME`` for one shipped with ``SparkContext.addFile``.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(_worker_path(rank_path), pattern)
        found = c.tokenizer.encode_batch(batch.column("text").to_pylist(), add_special_tokens=False)
        spans = [e.offsets for e in found]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([e.ids for e in found], pa.list_(pa.int32())),
             pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int32())),
             pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int32()))],
            names=["doc_id", "ids", "starts", "ends"])
    return map_batches(documents_of(docs), run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_ids(tokens: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, data binary) of (doc_id, ids array<int>); null ids decode to null."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(_worker_path(rank_path), pattern)
        data = [None if ids is None else decode(c, ids) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())],
                                          names=["doc_id", "data"])
    return map_batches(tokens.select(F.col("doc_id").cast("long"), "ids"), run, "doc_id long, data binary")


def round_trip(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Encode and decode every text; digests of ids and of the decoded bytes."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(_worker_path(rank_path), pattern)
        counts, id_digests, data_digests, same = [], [], [], []
        texts = batch.column("text").to_pylist()
        for text, words in zip(texts, encode_words(c, texts), strict=True):
            data = b"".join([w[2] for w in words])
            counts.append(sum([w[1] for w in words]))
            id_digests.append(hashlib.sha256(" ".join([w[0] for w in words if w[1]]).encode()).hexdigest())
            data_digests.append(hashlib.sha256(data).hexdigest())
            same.append(data == text.encode())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(data_digests),
             pa.array(same, pa.bool_())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])
    return map_batches(documents_of(docs), run,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
