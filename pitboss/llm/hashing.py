"""Vectorised hashing of byte spans, words and word shingles (numpy).

A span's hash is a polynomial in an odd 64-bit base over a random table of
byte values, taken from prefix sums, so every span costs two look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes hashed at a time: bounds the 8-byte-per-byte temporary arrays.
PART_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BASE = int(_rng.integers(1 << 62, dtype=np.int64)) * 2 + 1
BYTES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
# Same table with A-Z read as a-z.
LOWER = BYTES.copy()
LOWER[65:91] = LOWER[97:123]
_SEATS = _rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        have = np.full(max(n, PART_BYTES + 64), base, np.uint64)
        have[0] = 1
        _powers[kind] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Spans:
    """Hashes of spans of one byte array."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTES):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * _power("up", len(data)), out=self.sums[1:])
        self.back = _power("down", len(data) + 1)

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def windows(self, size: int) -> np.ndarray:
        """Raw hash of the window of ``size`` bytes at every position that has one."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.back[:n] if n > 0 else np.zeros(0, np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the rows' offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk, or too many bytes for one
            column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks \
                else pa.array([], pa.string())
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(offsets: np.ndarray, limit: int = PART_BYTES):
    """Row ranges of about ``limit`` bytes; a longer row is one range."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of the words ``[^\\x20\\x09-\\x0D]+`` of every row."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def sequence_hash(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive word hashes from each start."""
    h = np.full(len(starts), size, np.uint64)
    for k in range(size):
        h += words[starts + k] * _SEATS[k % len(_SEATS)]
        if k % len(_SEATS) == len(_SEATS) - 1:
            h = mix(h)
    return mix(h)


def shingle_sets(column: pa.Array | pa.ChunkedArray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Every row's set of word shingles: (shingles per row, hashes by row, sorted).

    Words are lower-cased (A-Z).  A row of fewer words has its whole sequence
    as one shingle; a row without words has none.
    """
    data, offsets = text_bytes(column)
    counts, hashes = [], []
    for a, b in parts(offsets):
        at = offsets[a:b + 1] - offsets[a]
        piece = data[offsets[a]:offsets[b]]
        starts, ends, row = word_spans(piece, at)
        words = mix(Spans(piece, LOWER).raw(starts, ends))
        n_words = np.bincount(row, minlength=b - a)
        last = np.cumsum(n_words)
        full = np.flatnonzero(np.arange(len(words)) + size <= last[row]) if len(row) else np.zeros(0, np.int64)
        h, r = sequence_hash(words, full, size), row[full]
        short = np.flatnonzero((n_words > 0) & (n_words < size))
        if len(short):
            extra = [sequence_hash(words, last[short[n_words[short] == k]] - k, k) for k in range(1, size)]
            rows = [short[n_words[short] == k] for k in range(1, size)]
            h, r = np.concatenate([h, *extra]), np.concatenate([r, *rows])
        order = np.lexsort((h, r))
        h, r = h[order], r[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        hashes.append(h[new])
        counts.append(np.bincount(r[new], minlength=b - a))
    return (np.concatenate(counts) if counts else np.zeros(0, np.int64),
            np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))
