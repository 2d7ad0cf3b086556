"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at the vocabulary's special strings (one token each, as its
library does by default) and then into words by the byte-level cut.  A word
starts as one symbol a byte, doubly linked; its adjacent pairs stand in a heap
by merge rank and place.  The lowest pair is popped and merged, its two new
neighbour pairs are pushed, pairs whose symbols changed meanwhile are passed
over.  The count is initial symbols minus merges: no token is ever looked up
in the vocabulary or emitted.  A word of n bytes costs O(n log n), so a text
that is one huge word stays affordable.

Counts of short words are kept in a table of bounded size per worker; every
text is counted whole, in one pass over Arrow batches without a shuffle.

Defined cases: a null text is empty (0 bytes, 0 tokens); a null doc_id and
repeated rows give one row each; an empty table gives no row; other columns
are ignored.  Characters that Unicode data may class differently in the two
libraries (unassigned ones) are cut by the vocabulary's library itself.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .bpe import _worker_path
from .common import documents_of, map_batches

# Words kept in a worker's table, and the longest word kept there: bounds its memory.
TABLE_WORDS = 1 << 18
TABLE_CHARS = 64
# Texts longer than this are cut word by word instead of into one list of words.
LIST_CHARS = 1 << 20
# Fixed value: the cut of byte-level vocabularies.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class UnassignedCharacter(Exception):
    """A word holds a character whose class depends on the Unicode version."""


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable
    Latin-1 bytes are themselves, the others take the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for byte in range(256):
        out.append(chr(byte if byte in plain else spare))
        spare += byte not in plain
    return out


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges ``ranks`` allows on ``symbols``, lowest rank first, then leftmost."""
    n = len(symbols)
    symbols = [*symbols, ""]  # the end never merges
    after, before = list(range(1, n + 2)), list(range(-1, n))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if symbols[i] else n
        if ranks.get((symbols[i], symbols[j])) != rank:  # one of the two has been merged since
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        after[i] = k = after[j]
        before[k] = i
        merges += 1
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and (new := ranks.get((symbols[left], symbols[right]))) is not None:
                heapq.heappush(heap, (new, left))
    return merges


class WordCounts(dict):
    """Token count of each word, computed when first asked for."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        super().__init__()
        self.ranks, self.symbols = ranks, byte_symbols()

    def count(self, word: str) -> int:
        data = word.encode()
        return len(data) - merge_count([self.symbols[b] for b in data], self.ranks)

    def __missing__(self, word: str) -> int:
        if not word.isascii() and any(unicodedata.category(c) == "Cn" for c in set(word)):
            raise UnassignedCharacter
        n = self.count(word)
        if len(word) <= TABLE_CHARS:
            if len(self) >= TABLE_WORDS:
                self.clear()
            self[word] = n
        return n


class Counter:
    """Counts the tokens of texts by one byte-level vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        strict = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if (model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix",
                                                                 "continuing_subword_prefix"))
                or spec["normalizer"] or any(cut.get(k) != v for k, v in strict.items())
                or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.words = WordCounts({(a, b): rank for rank, (a, b) in enumerate(pairs)})
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.word = regex.compile(WORD)
        self.path = path

    def cut_by_library(self, text: str) -> Iterable[str]:
        from tokenizers import pre_tokenizers

        cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return (text[a:b] for _, (a, b) in cut.pre_tokenize_str(text))

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        try:
            if len(text) > LIST_CHARS:
                return sum(self.words[m.group()] for m in self.word.finditer(text))
            return sum(map(self.words.__getitem__, self.word.findall(text)))
        except UnassignedCharacter:
            return sum(map(self.words.count, self.cut_by_library(text)))

    def tokens(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``vocabulary`` is read by each worker: a file installed on every machine,
    or ``files:NAME`` for one shipped with ``SparkContext.addFile``.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counter(_worker_path(vocabulary))
        texts = batch.column("text")
        counts = pa.array([c.tokens(t) for t in texts.to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pc.cast(pc.binary_length(texts), pa.int64()), counts, pc.greater(counts, limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return map_batches(documents_of(docs), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
