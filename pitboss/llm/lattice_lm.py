"""Language-model scoring by subword-lattice likelihood (operator 6).

Words are generated piece by piece from an existing subword vocabulary: a
first piece, then inner pieces until a stop.  The probability of a word is
the sum over all its segmentations, by the forward recursion in log space over
the lattice of vocabulary pieces (every single byte is a piece, so every word
has one).  Piece weights start from the vocabulary's own scores (its ranks, as
a Zipf curve) and are re-estimated by expectation-maximisation over the distinct
words of the training documents: each counts once, since the lattice has to
do for words that were not seen.

A whole training word is one more arc across its lattice: with absolute
discounting, P(w) = max(c - d, 0) / N + d * V / N * lattice(w).

Corpora mix languages, so pieces and counts are kept per class of documents:
CLASSES multinomial profiles of byte pairs, fitted by hard EM over all training
documents, name a text's class k.  The first profiles are single documents,
drawn with chances that grow with their length and the squared distance from
those drawn before (k-means++); each draw and each round is one pass over the documents' stored
byte-pair counts, and only sums by class and pair leave it.  Sums are of whole
numbers, so they do not depend on the order of rows.  A document's score
is log10 of share(k) times the probability of its words and its end in class
k: one term of the mixture over classes, hence a bound of its probability
from below.

Counts come from the whole corpus: chunks send their distinct words to
buckets, a bucket answers with count and lattice likelihood, computed once a
word.  Only sums over pieces (bounded by the vocabulary) and byte pairs (PROFILE
a class), the documents drawn and four totals go through the driver.

Defined cases: null and empty texts consist of their end; rows with a null
doc_id are scored, are not held out and not learned from; repeated rows
count each; without training tokens the counts are 0 and the lattice alone
scores.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange
from .common import documents_of, map_batches, materialize, small_batches
from .hashing import BYTES, Spans, mix, parts, text_bytes, word_spans

FOLDS, HELD_OUT = 7, 2
ROUNDS = 3
LONGEST_PIECE = 16
CLASSES, PROFILE = 6, 2048
CLASS_ROUNDS = 15
UNIT = 1 << 20  # a document's byte-pair counts are scaled to about this sum
WORDS_AT_ONCE = 1 << 20  # bytes of words whose lattices are in memory together
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def read_vocabulary(path: str) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
    """First pieces, inner pieces and their scores' ranks from a sentencepiece
    model.  A first piece is one that begins with the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    mark = "▁"
    first: dict[bytes, float] = {}
    inner: dict[bytes, float] = {}
    order = sorted((i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)),
                   key=lambda i: (-model.get_score(i), i))
    for rank, i in enumerate(order):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            text = bytes([int(piece[3:5], 16)])
            inner.setdefault(text, rank)
            continue
        text = piece.replace(mark, " ").encode()
        start, text = text.startswith(b" "), text.lstrip(b" ")
        if b" " in text or len(text) > LONGEST_PIECE:
            continue
        text = _LOWER[np.frombuffer(text, np.uint8)].tobytes()
        (first if start else inner).setdefault(text, rank)
    for b in range(256):
        inner.setdefault(bytes([b]), len(order))
    first.setdefault(b"", len(order))
    return list(first), list(inner), np.array([*first.values()], float), np.array([*inner.values()], float)


class Pieces:
    """Pieces by length and hash; ids count first pieces, inner pieces, then the stop."""

    def __init__(self, first: list[bytes], inner: list[bytes]):
        self.n_first, self.size = len(first), len(first) + len(inner) + 1
        self.stop = self.size - 1
        self.bare = first.index(b"")
        self.first = self._index(first, 0)
        self.inner = self._index(inner, len(first))

    @staticmethod
    def _index(pieces: list[bytes], base: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out = {}
        for size in sorted({len(p) for p in pieces} - {0}):
            ids = np.array([i for i, p in enumerate(pieces) if len(p) == size])
            h = Spans(np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8)).windows(size)[::size]
            order = np.argsort(h)
            maybe = np.zeros(1 << 16, bool)
            maybe[(mix(h) >> np.uint64(48)).astype(np.int64)] = True
            out[size] = h[order], ids[order] + base, maybe
        return out


def _find(index: tuple, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in h, piece ids) of the pieces among hashes."""
    known, ids, maybe = index
    near = np.flatnonzero(maybe[(mix(h) >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, h[near]), len(known) - 1)
    hit = known[at] == h[near]
    return near[hit], ids[at[hit]]


class Lattice:
    """Arcs of a set of words, ordered by the step (bytes into the word) they end at."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces):
        self.n, self.pieces = len(starts), pieces
        length = ends - starts
        self.length = length
        # node of word w after t bytes: base[w] + t
        self.base = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        self.nodes = int((length + 1).sum())
        spans = Spans(data)
        word = np.repeat(np.arange(self.n), length)
        step = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
        place = np.repeat(starts, length) + step
        left = np.repeat(length, length) - step
        tail, head, ids, depth = [], [], [], []

        def add(at, t, w, found, size, begin):
            # a first piece begins at the word's root, an inner piece where the last ended
            tail.append(np.full(len(w), -1) if begin else self.base[w] + t)
            head.append(self.base[w] + t + size)
            ids.append(found)
            depth.append(t + size)

        for size, index in pieces.inner.items():
            open_ = np.flatnonzero(left >= size)
            if len(open_):
                at, found = _find(index, spans.raw(place[open_], place[open_] + size))
                add(at, step[open_[at]], word[open_[at]], found, size, False)
        for size, index in pieces.first.items():
            open_ = np.flatnonzero(length >= size)
            if len(open_):
                at, found = _find(index, spans.raw(starts[open_], starts[open_] + size))
                add(at, np.zeros(len(at), np.int64), open_[at], found, size, True)
        tail, head, ids, depth = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (tail, head, ids, depth))
        order = np.lexsort((head, depth))
        self.tail, self.head, self.ids = tail[order], head[order], ids[order]
        self.steps = np.searchsorted(depth[order], np.arange(1, (int(length.max()) if self.n else 0) + 2))

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log weight of all paths to each node."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.base] = weight[self.pieces.bare]
        for lo, hi in zip(self.steps[:-1], self.steps[1:], strict=True):
            if lo < hi:
                tail, head = self.tail[lo:hi], self.head[lo:hi]
                arc = weight[self.ids[lo:hi]] + np.where(tail < 0, 0, alpha[tail])
                cut = np.flatnonzero(np.diff(head, prepend=-1))
                alpha[head[cut]] = _log_sums(arc, cut)
        return alpha

    def likelihood(self, weight: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        return self.forward(weight)[self.base + self.length] + weight[self.pieces.stop]

    def expected(self, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations, words counted ``count`` times."""
        alpha = self.forward(weight)
        beta = np.full(self.nodes, -np.inf)
        end = self.base + self.length
        beta[end] = weight[self.pieces.stop]
        for lo, hi in zip(self.steps[-2::-1], self.steps[:0:-1], strict=True):
            inner = np.flatnonzero(self.tail[lo:hi] >= 0) + lo
            if len(inner):
                np.logaddexp.at(beta, self.tail[inner], weight[self.ids[inner]] + beta[self.head[inner]])
        total = alpha[end] + weight[self.pieces.stop]
        word = np.repeat(np.arange(self.n), self.length + 1)[self.head] if self.n else self.head
        before = np.where(self.tail < 0, 0, alpha[self.tail])
        use = np.exp(before + weight[self.ids] + beta[self.head] - total[word]) * count[word]
        uses = np.bincount(self.ids, weights=use, minlength=self.pieces.size)
        uses[self.pieces.bare] += (np.exp(weight[self.pieces.bare] + beta[self.base] - total) * count).sum()
        uses[self.pieces.stop] += count.sum()
        return uses


def _log_sums(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Log of the sums of exp(x) over the runs that begin at ``cut``."""
    top = np.maximum.reduceat(x, cut)
    top = np.where(np.isfinite(top), top, 0)
    size = np.diff(np.append(cut, len(x)))
    with np.errstate(divide="ignore"):
        return top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, size)), cut))


def weights_of(uses: np.ndarray, pieces: Pieces, prior: np.ndarray) -> np.ndarray:
    """Log weights from expected uses, smoothed by a thousandth of the prior."""
    out = np.empty(pieces.size)
    for part in (slice(0, pieces.n_first), slice(pieces.n_first, pieces.size)):
        own = prior[part] / prior[part].sum()
        total = uses[part].sum()
        out[part] = np.log((uses[part] + max(1.0, 0.001 * total) * own) / (total + max(1.0, 0.001 * total)))
    return out


def prior_of(first_rank: np.ndarray, inner_rank: np.ndarray) -> np.ndarray:
    """The vocabulary's scores as a Zipf curve; a quarter of inner steps stop."""
    first, inner = 1 / (first_rank + 3), 1 / (inner_rank + 3)
    return np.concatenate([first / first.sum(), 0.75 * inner / inner.sum(), [0.25]])


def _batches(lengths: np.ndarray):
    """Words in order of length, in batches of about WORDS_AT_ONCE bytes."""
    order = np.argsort(lengths, kind="stable")
    total = np.concatenate([[0], np.cumsum(lengths[order])])
    for a, b in parts(total, WORDS_AT_ONCE):
        yield order[a:b]


def _word_blob(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The words, each followed by a space."""
    size = ends - starts + 1
    at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
    out = data[np.minimum(at, len(data) - 1)]
    out[np.cumsum(size) - 1] = 32
    return out


def _pair_table() -> np.ndarray:
    """Hash of the lower-cased pair of two bytes, at 256 * first + second."""
    low = _LOWER.astype(np.int64)
    return ((low[:, None] * 257 + low) * 40503 % 65521 % PROFILE).ravel()


_PAIRS = _pair_table()


def byte_pairs(column: pa.Array | pa.ChunkedArray):
    """(first row, counts of hashed lower-cased byte pairs of some rows), block by block."""
    data, offsets = text_bytes(column)
    step = max(1, (1 << 21) // PROFILE)
    for a, b in parts(offsets):
        at = offsets[a:b + 1] - offsets[a]
        piece = data[offsets[a]:offsets[b]].astype(np.uint16)
        pair = _PAIRS[piece[:-1] << 8 | piece[1:]]
        row = np.repeat(np.arange(b - a), np.diff(at))
        inside = row[:-1] == row[1:]
        for lo in range(0, b - a, step):
            n = min(step, b - a - lo)
            part = slice(at[lo], at[lo + n])
            ok = inside[part]
            own = (row[:-1][part][ok] - lo) * PROFILE + pair[part][ok]
            yield a + lo, np.bincount(own, minlength=n * PROFILE).reshape(n, PROFILE).astype(np.float32)


def classes_of(column: pa.Array | pa.ChunkedArray, profiles: np.ndarray) -> np.ndarray:
    """Most likely class of every text."""
    return np.concatenate([np.zeros(0, np.int64), *[np.argmax(counts @ profiles.T.astype(np.float32), axis=1)
                                                    for _, counts in byte_pairs(column)]]).astype(np.int64)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(doc_id, chance, pairs, counts) of ``texts(doc_id, text)``: the byte pairs of each
    text with their counts, and a number in 0 to 1 that follows from its doc_id."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs, counts = [], []
        for _, block in byte_pairs(batch.column("text")):
            row, pair = np.nonzero(block)
            n = block[row, pair].astype(np.uint32)
            cuts = np.searchsorted(row, np.arange(len(block) + 1))
            pair = pair.astype(np.uint16)
            pairs += [pair[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            counts += [n[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("chance"), pa.array(pairs, pa.binary()), pa.array(counts, pa.binary())],
            names=["doc_id", "chance", "pairs", "counts"])
    chance = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return materialize(map_batches(texts.select("doc_id", chance.alias("chance"), "text"), run,
                                   "doc_id long, chance double, pairs binary, counts binary"))


def _dense(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair, count) of a batch of ``pair_counts``, and the counts as a matrix."""
    pair = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), np.uint16).astype(np.int64)
    count = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), [len(x.as_buffer()) // 2 for x in batch.column("pairs")])
    matrix = np.zeros((batch.num_rows, PROFILE), np.float32)
    matrix[row, pair] = count
    return row, pair, count, matrix


def _parts_of(row: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Counts as whole UNITths of their row's sum."""
    total = np.bincount(row, weights=count, minlength=n).astype(np.int64)
    return count * UNIT // np.maximum(1, total)[row]


def _class_sums(counted: DataFrame, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the documents' scaled byte pairs by their most likely class, and the
    number of documents with any in each class."""
    def run(batches):
        sums = np.zeros((len(profiles), PROFILE + 1), np.int64)
        for batch in batches:
            row, pair, count, matrix = _dense(batch)
            own = np.argmax(matrix @ profiles.T.astype(np.float32), axis=1)
            scaled = _parts_of(row, count, batch.num_rows)
            sums[:, :PROFILE] += np.bincount(own[row] * PROFILE + pair, weights=scaled, minlength=len(profiles) * PROFILE
                                             ).reshape(-1, PROFILE).astype(np.int64)
            sums[:, PROFILE] += np.bincount(own[np.unique(row)], minlength=len(profiles))
        kind, pair = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(pair, pa.int32()),
                                          pa.array(sums[kind, pair])], names=["class", "pair", "n"])
    small_batches(counted.sparkSession)
    sums = np.zeros((len(profiles), PROFILE + 1), np.int64)
    for k, pair, n in (counted.select("pairs", "counts").mapInArrow(run, "class int, pair int, n long")
                       .groupBy("class", "pair").agg(F.sum("n")).collect()):  # one row a class and pair
        sums[k, pair] = n
    return sums[:, :PROFILE] / UNIT, sums[:, PROFILE]


def _drawn(counted: DataFrame, centres: list[np.ndarray]) -> np.ndarray:
    """Scaled byte pairs of one document, drawn from all that have any with chances in
    proportion to their number of pairs and the squared distance from the nearest of
    ``centres`` (if any): the least of exponential numbers with these rates."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        row, pair, count, matrix = _dense(batch)
        some = np.unique(row)
        if not len(some):
            return None
        matrix[row, pair] = _parts_of(row, count, batch.num_rows) / UNIT
        rate = np.bincount(row, weights=count)[some]
        if centres:
            near = [((matrix[some] - c.astype(np.float32)) ** 2).sum(axis=1, dtype=np.float64) for c in centres]
            rate = rate * np.maximum(np.min(near, axis=0), 1e-300)
        wait = -np.log(batch.column("chance").to_numpy()[some]) / rate
        one = some[np.flatnonzero(wait == wait.min())]
        columns = [batch.column(k).take(pa.array(one)) for k in ("doc_id", "pairs", "counts")]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(one), wait.min())), *columns],
                                          names=["wait", "doc_id", "pairs", "counts"])
    found = map_batches(counted, run, "wait double, doc_id long, pairs binary, counts binary")
    first = found.agg(F.min(F.struct("wait", "doc_id", "pairs", "counts")).alias("one")).first()["one"]
    pair, count = np.frombuffer(first["pairs"], np.uint16), np.frombuffer(first["counts"], np.uint32).astype(np.int64)
    out = np.zeros(PROFILE)
    out[pair] = _parts_of(np.zeros(len(pair), np.int64), count, 1) / UNIT
    return out


def fit_classes(counted: DataFrame, classes: int = CLASSES, rounds: int = CLASS_ROUNDS) -> np.ndarray:
    """Log profiles of classes of the texts of ``pair_counts`` (hard EM of a multinomial
    mixture over all of them), from starts far from each other."""
    sums, n = _class_sums(counted, np.zeros((1, PROFILE)))
    if not n[0]:
        return np.full((1, PROFILE), -math.log(PROFILE))
    background = sums[0] / n[0] + 1e-6
    centre: list[np.ndarray] = []
    while len(centre) < min(classes, n[0]):
        centre.append(_drawn(counted, centre))
    before = None
    for _ in range(rounds):
        sums, n = _class_sums(counted, np.log(np.stack([0.9 * c + 0.1 * background for c in centre])))
        if before is not None and (sums == before).all():
            break  # no document changes its class any more
        before = sums
        centre = [sums[k] / n[k] if n[k] else centre[k] for k in range(len(centre))]
    logs = np.stack([0.9 * c + 0.1 * background for c in centre])
    return np.log(logs / logs.sum(axis=1, keepdims=True))


def _chunk_words(rows: pa.Table, profiles: np.ndarray):
    """(lower-cased bytes, starts, ends, row, number of the distinct (word, class), first of
    each, key of each, class of each row).  A key is the word's hash, its last four bits the class."""
    kind = classes_of(rows.column("text"), profiles)
    data, offsets = text_bytes(rows.column("text"))
    data = _LOWER[data]
    hashes, begin, stop, of = [], [], [], []
    for a, b in parts(offsets):
        piece = data[offsets[a]:offsets[b]]
        starts, ends, row = word_spans(piece, offsets[a:b + 1] - offsets[a])
        hashes.append(mix(Spans(piece, BYTES).raw(starts, ends)))
        begin.append(starts + offsets[a])
        stop.append(ends + offsets[a])
        of.append(row + a)
    hashes, begin, stop, of = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, begin, stop, of))
    keys = (hashes.astype(np.uint64) & ~np.uint64(15)) | kind[of].astype(np.uint64)
    known, one, number = np.unique(keys, return_index=True, return_inverse=True)
    return data, begin, stop, of, number, one, known, kind


ASKED = "bucket int, chunk int, words binary, counts binary, classes binary, n_words int"


def _ask_words(bits: int, profiles: np.ndarray):
    def run(rows: pa.Table) -> pa.Table:
        data, begin, stop, of, number, one, known, _ = _chunk_words(rows, profiles)
        train = rows.column("train").to_numpy()
        counts = np.bincount(number, weights=train[of], minlength=len(known)).astype(np.uint32)
        classes = (known & np.uint64(15)).astype(np.uint8)
        cuts = np.searchsorted(known >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        full = [i for i in range(1 << bits) if cuts[i] < cuts[i + 1]]
        part = [slice(cuts[i], cuts[i + 1]) for i in full]
        return pa.table({
            "bucket": pa.array(full, pa.int32()), "chunk": pa.array([rows.column("chunk")[0].as_py()] * len(full), pa.int32()),
            "words": pa.array([_word_blob(data, begin[one[p]], stop[one[p]]).tobytes() for p in part], pa.binary()),
            "counts": pa.array([counts[p].tobytes() for p in part], pa.binary()),
            "classes": pa.array([classes[p].tobytes() for p in part], pa.binary()),
            "n_words": pa.array([p.stop - p.start for p in part], pa.int32())})
    return run


def _bucket_words(rows: pa.Table, n_classes: int):
    """(bytes, starts, ends, number of each entry's word, its class, first entry of each word,
    counts of each word by class)."""
    data = np.frombuffer(b"".join(rows.column("words").to_pylist()), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    hashes = np.concatenate([mix(Spans(data[starts[i]:ends[j - 1]]).raw(starts[i:j] - starts[i], ends[i:j] - starts[i]))
                             for i, j in parts(np.append(starts, len(data)))])
    _, one, number = np.unique(hashes, return_index=True, return_inverse=True)
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint32)
    kind = np.frombuffer(b"".join(rows.column("classes").to_pylist()), np.uint8).astype(np.int64)
    by_class = np.bincount(number * n_classes + kind, weights=counts, minlength=len(one) * n_classes)
    return data, starts, ends, number, kind, one, by_class.reshape(len(one), n_classes)


VOCABULARY = "class int, words binary, counts binary, tokens long, seen long, once long, twice long, alone long"


def _vocabulary(n_classes: int):
    """A bucket's training words and their counts, a row per class; ``alone``
    counts words in the first class that has them, for the whole vocabulary's size."""
    def run(rows: pa.Table) -> pa.Table:
        data, starts, ends, _, _, one, counts = _bucket_words(rows, n_classes)
        first = np.argmax(counts > 0, axis=1)
        out = []
        for k in range(n_classes):
            has = counts[:, k] > 0
            known, own = one[has], counts[has, k].astype(np.int64)
            out.append((k, _word_blob(data, starts[known], ends[known]).tobytes() if len(known) else b"", own.tobytes(),
                        int(own.sum()), len(own), int((own == 1).sum()), int((own == 2).sum()),
                        int((first[has] == k).sum())))
        types = (pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 5)
        names = ("class", "words", "counts", "tokens", "seen", "once", "twice", "alone")
        return pa.table({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})
    return run


def learn(vocabulary: DataFrame, pieces: Pieces, prior: np.ndarray, n_classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Log weights of pieces by class after ``rounds`` of expectation-maximisation."""
    weight = np.tile(np.log(prior), (n_classes, 1))
    for _ in range(rounds):
        current = weight

        def expect(batches, current=current):
            uses = np.zeros((n_classes, pieces.size))
            for batch in batches:
                for k, words in zip(batch.column("class").to_pylist(), batch.column("words"), strict=True):
                    data = np.frombuffer(words.as_buffer(), np.uint8)
                    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
                    for some, lattice in _lattices(data, starts, ends, np.arange(len(starts)), pieces):
                        uses[k] += lattice.expected(current[k], np.ones(len(some)))
            kind, used = np.nonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(used, pa.int32()),
                                              pa.array(uses[kind, used])], names=["class", "piece", "uses"])
        small_batches(vocabulary.sparkSession)
        rows = (vocabulary.select("class", "words").mapInArrow(expect, "class int, piece int, uses double")
                .groupBy("class", "piece").agg(F.sum("uses").alias("uses")).collect())  # one row a class and piece
        uses = np.zeros((n_classes, pieces.size))
        for k, piece, n in rows:
            uses[k, piece] = n
        weight = np.stack([weights_of(u, pieces, prior) for u in uses])
    return weight


def _lattices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, pieces: Pieces):
    """(some of ``words``, their lattice), in batches of bounded size."""
    for some in _batches((ends - starts)[words]):
        some = words[some]
        blob = _word_blob(data, starts[some], ends[some])
        size = (ends - starts)[some]
        last = np.cumsum(size + 1) - 1
        yield some, Lattice(blob, last - size, last, pieces)


def score(docs: DataFrame, model_path: str, rounds: int = ROUNDS, classes: int = CLASSES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    first, inner, first_rank, inner_rank = read_vocabulary(model_path)
    pieces, prior = Pieces(first, inner), prior_of(first_rank, inner_rank)
    texts = documents_of(docs)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    counted = pair_counts(texts.where(fold != HELD_OUT))
    profiles = fit_classes(counted, classes)
    k_all = len(profiles)
    chunks, bits = exchange.chunked(texts)
    chunks = (chunks.withColumn("held_out", F.coalesce(fold == HELD_OUT, F.lit(False)))
              .withColumn("train", F.coalesce(fold != HELD_OUT, F.lit(False))))
    asked = materialize(chunks.groupBy("chunk").applyInArrow(_ask_words(bits, profiles), ASKED))
    vocabulary = materialize(asked.groupBy("bucket").applyInArrow(_vocabulary(k_all), VOCABULARY))
    stats = np.zeros((k_all, 5))
    for r in vocabulary.groupBy("class").agg(*[F.sum(c) for c in ("tokens", "seen", "once", "twice", "alone")]).collect():
        stats[r[0]] = r[1:]

    def kinds_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = np.argmax(_dense(batch)[3] @ profiles.T.astype(np.float32), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(np.ones(len(kind), np.int64))],
                                          names=["class", "n"])
    ends = np.zeros(k_all)  # one end a training document
    trained = map_batches(counted.select("pairs", "counts"), kinds_of, "class int, n long")
    for r in trained.groupBy("class").agg(F.sum("n")).collect():
        ends[r[0]] = r[1]
    tokens, seen, once, twice, alone = stats.T
    total, kinds, n_ends = int(tokens.sum() + ends.sum()), int(alone.sum() + (ends.sum() > 0)), int(ends.sum())
    weight = learn(vocabulary, pieces, prior, k_all, rounds)
    # by class: tokens, discount, log of the mass left to the lattice
    own = np.maximum(1, tokens + ends)
    discount = np.where((once > 0) & (twice > 0), once / np.maximum(1, once + 2 * twice), 0.5)
    spare = np.log(np.where(tokens + ends > 0, np.minimum(1, discount * (seen + (ends > 0)) / own), 1.0))

    def respond(rows: pa.Table) -> pa.Table:
        data, starts, stops, number, kind, one, counts = _bucket_words(rows, k_all)
        chance = np.empty(len(number))
        place = np.empty(len(starts))
        for k in range(k_all):
            entries = np.flatnonzero(kind == k)
            words = np.unique(one[number[entries]])
            for some, lattice in _lattices(data, starts, stops, words, pieces):
                place[some] = lattice.likelihood(weight[k])
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(counts[number[entries], k] - discount[k], 0) / own[k])
            chance[entries] = np.logaddexp(whole, spare[k] + place[one[number[entries]]]) / math.log(10)
        chance = chance.astype(np.float32)
        every = counts.sum(axis=1).astype(np.uint32)[number]
        cuts = np.concatenate([[0], np.cumsum(rows.column("n_words").to_numpy())])
        cuts = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
                         "counts": pa.array([every[a:b].tobytes() for a, b in cuts], pa.binary()),
                         "chances": pa.array([chance[a:b].tobytes() for a, b in cuts], pa.binary())})
    answers = asked.groupBy("bucket").applyInArrow(respond, "chunk int, bucket int, counts binary, chances binary")
    base_total = total + kinds + 1
    end_base = math.log10((n_ends + 1) / base_total)
    # share of the class and the end of the document in it
    closing = np.log10((ends + 0.5) / (ends + 0.5).sum()) + np.log10(np.maximum(ends - discount, 0.5) / own)

    def finish(rows: pa.Table, known: pa.Table) -> pa.Table:
        _, _, _, of, number, _, _, kind = _chunk_words(rows, profiles)
        n = rows.num_rows
        counts = exchange.answers_in_order(known.rename_columns(["chunk", "bucket", "answers", "x"]), "u4")
        chances = exchange.answers_in_order(known.rename_columns(["chunk", "bucket", "x", "answers"]), "f4")
        base = np.log10((counts.astype(np.float64) + 1) / base_total)[number]
        return pa.table({
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"),
            "n_tokens": pa.array(np.bincount(of, minlength=n) + 1, pa.int64()),
            "n_known": pa.array(np.bincount(of, weights=(counts > 0)[number], minlength=n).astype(np.int64)
                                + (n_ends > 0), pa.int64()),
            "train_tokens": pa.array(np.full(n, total), pa.int64()),
            "base_score": pa.array(np.bincount(of, weights=base, minlength=n) + end_base),
            "score": pa.array(np.bincount(of, weights=chances[number].astype(float), minlength=n) + closing[kind])})
    return exchange.apply_answers(chunks, answers, finish,
                                  "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double")
