"""Toxicity: subsequence-kernel SVM on Nyström landmarks (operator 4).

A sentence's spans are its words, letters only, and runs of one-letter
words joined together ("i d i o t").  A span is compared with
landmark strings by the normalised string subsequence kernel: common
subsequences of ORDER characters, each weighted by DECAY to the power of the
length it takes up in both strings, so gaps and inserted characters lower the
value but do not end the match.  The kernel counts from FLOOR up, where the
longest common subsequence covers SHARE of the landmark, else as 0.  A
sentence's kernel value for a landmark is the best of its spans.

Landmarks are words of toxic training texts, or beginnings of words, chosen
greedily so that they explain the toxic documents and hardly occur in others.
The sentence's kernel values and their POWERS (products of a kernel are
kernels), mapped by the inverse root of the landmarks' kernel matrix
(Nyström), are the features of a linear SVM.  It is trained on sentences: of
a toxic document the sentence that scores highest is the labelled one, found
anew in each round; of other documents all are.  Landmarks alone, and with an
inserted character, are further toxic sentences.  A document's score is its
worst sentence's, calibrated to (0, 1).

Defined cases: null, empty and blank texts have the score of a sentence
without any match; long words are compared in overlapping windows of SPAN
bytes, so no text is cut off; rows with a null doc_id are scored and not held
out; without toxic labels all scores are that empty sentence's (0.5 without
any label).  Labels, lang, source and doc_id are no inputs.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of, map_batches, materialize
from .hashing import BYTES, Spans, mix, parts, text_bytes
from .labels import held_out, sample

FIT_DOCS = 12_000
LANDMARKS = 192
ORDER, DECAY = 3, 0.6
SPAN, STEP = 24, 12
SHORTEST, LONGEST = 4, 16
STEMS = (5, 6, 7, 8, 9)  # bytes of the word beginnings that may be landmarks
LEAST_HOLDERS = 3  # toxic documents that hold a landmark
POWERS = (1, 16)  # of the kernel: a tolerant one and one for nearly exact matches
RIDGE = 1e-4
SHARE = 0.8  # of a landmark's characters that a span must hold in order
FLOOR = 0.2  # kernel values up to this count as 0
TOXIC_WEIGHT = 3.0  # of a toxic sentence against one of a clean document

# Characters of a span: lower-cased letters; other ASCII is dropped.
_FOLD = np.zeros(256, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_BREAK = np.zeros(256, bool)
_BREAK[list(b".!?\n\r")] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r\x0b\x0c")] = True


def fold(text: str) -> bytes:
    """The characters of a span, as the kernel sees them."""
    folded = _FOLD[np.frombuffer(text.encode(), np.uint8)]
    return folded[folded > 0].tobytes()


def padded(strings: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(strings), width), np.uint8)
    for i, s in enumerate(strings):
        out[i, :min(len(s), width)] = np.frombuffer(s[:width], np.uint8)
    return out


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of the rows of s and t (0: no character)."""
    n, width = t.shape
    t_on = t > 0
    # inner[i][:, j]: weighted common subsequences of length i of s so far and
    # t[:j], counted to the end of both
    inner = [np.ones((n, width + 1), np.float32)] + [np.zeros((n, width + 1), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(n, np.float32)
    square = np.float32(DECAY * DECAY)
    for k in range(s.shape[1]):
        c = s[:, k:k + 1]
        on = c[:, 0] > 0
        if not on.any():
            break
        match = (t == c) & t_on & on[:, None]
        total += square * (inner[ORDER - 1][:, :-1] * match).sum(axis=1)
        for i in range(ORDER - 1, 0, -1):
            reach = np.zeros(n, np.float32)
            new = inner[i] * np.where(on, np.float32(DECAY), np.float32(1))[:, None]
            below = inner[i - 1][:, :-1] * match * square
            for j in range(width):
                reach = np.where(t_on[:, j], DECAY * reach, reach) + below[:, j]
                new[:, j + 1] += reach
            inner[i] = np.where(on[:, None], new, inner[i])
    return total


def longest_common(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of the rows of s and t."""
    n, width = t.shape
    row = np.zeros((n, width + 1), np.int8)
    for k in range(s.shape[1]):
        c = s[:, k:k + 1]
        if not c.any():
            break
        hit = (t == c) & (c > 0)
        grown = np.maximum(row[:, 1:], np.where(hit, row[:, :-1] + 1, 0))
        row[:, 1:] = np.maximum.accumulate(grown, axis=1)
    return row[:, -1]


def _masks(strings: np.ndarray) -> np.ndarray:
    bit = np.where(strings > 0, np.uint64(1) << (strings % 64).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bit, axis=1)


class Landmarks:
    def __init__(self, words: list[bytes]):
        self.words = words
        self.chars = padded(words, LONGEST)
        self.length = np.array([len(w) for w in words], np.int64)
        self.mask = _masks(self.chars) if words else np.zeros(0, np.uint64)
        self.norm = subsequence_kernel(self.chars, self.chars) if words else np.zeros(0, np.float32)

    def gram(self) -> np.ndarray:
        m = len(self.words)
        a, b = np.repeat(np.arange(m), m), np.tile(np.arange(m), m)
        k = subsequence_kernel(self.chars[a], self.chars[b]) / np.sqrt(self.norm[a] * self.norm[b])
        return above_floor(k.reshape(m, m).astype(np.float64))

    def against(self, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(span, landmark, kernel) of the pairs that share enough."""
        found = []
        masks, need = _masks(spans), np.ceil(SHARE * self.length - 1e-9).astype(np.int64)
        for k in range(len(self.words)):
            near = np.flatnonzero(np.bitwise_count(self.mask[k] & ~masks) <= self.length[k] - need[k])
            if not len(near):
                continue
            t = np.broadcast_to(self.chars[k, :self.length[k]], (len(near), self.length[k]))
            near = near[longest_common(spans[near], t) >= need[k]]
            if len(near):
                found.append((near, np.full(len(near), k)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        span, mark = (np.concatenate([f[i] for f in found]) for i in range(2))
        value = np.empty(len(span))
        for lo in range(0, len(span), 20_000):
            s, t = spans[span[lo:lo + 20_000]], self.chars[mark[lo:lo + 20_000]]
            value[lo:lo + 20_000] = (subsequence_kernel(s, t)
                                     / np.sqrt(subsequence_kernel(s, s) * self.norm[mark[lo:lo + 20_000]]))
        value = above_floor(value)
        return span[value > 0], mark[value > 0], value[value > 0]


def above_floor(kernel: np.ndarray) -> np.ndarray:
    return np.maximum(0, (kernel - FLOOR) / (1 - FLOOR))


def sentence_kernels(data: np.ndarray, offsets: np.ndarray, marks: Landmarks) -> tuple[np.ndarray, ...]:
    """(row, sentence, landmark, kernel): sentences with a match, numbered over all rows."""
    none = np.zeros(0, np.int64)
    if not len(data) or not marks.words:
        return none, none, none, np.zeros(0)
    blank = _BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = ~blank & (np.concatenate([[True], blank[:-1]]) | edge[:-1])
    starts = np.flatnonzero(begin)
    if not len(starts):
        return none, none, none, np.zeros(0)
    row = np.searchsorted(offsets, starts, "right") - 1
    stop = np.concatenate([[0], np.cumsum(_BREAK[data])])
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (stop[starts[1:]] > stop[starts[:-1]])])
    sentence = np.cumsum(new) - 1
    # letters of the words, one after another
    char = _FOLD[data]
    at = np.flatnonzero(char)
    letters, word = char[at], (np.cumsum(begin) - 1)[at]
    size = np.bincount(word, minlength=len(starts))
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    # spans: words of SHORTEST letters or more, and runs of one-letter words
    tiny = size == 1
    link = tiny[1:] & tiny[:-1] & (sentence[1:] == sentence[:-1])
    run_first = np.flatnonzero(tiny & ~np.concatenate([[False], link]))
    run_last = np.flatnonzero(tiny & ~np.concatenate([link, [False]]))
    joined = run_last - run_first >= 1
    lo = np.concatenate([first[size >= SHORTEST], first[run_first[joined]]])
    hi = np.concatenate([(first + size)[size >= SHORTEST], (first + size)[run_last[joined]]])
    own = np.concatenate([np.flatnonzero(size >= SHORTEST), run_first[joined]])
    keep = hi - lo >= SHORTEST
    lo, hi, own = lo[keep], hi[keep], own[keep]
    extra = np.maximum(0, -(-(hi - lo - SPAN) // STEP))  # windows of long spans
    number = np.repeat(np.arange(len(lo)), extra + 1)
    window = np.arange(len(number)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
    lo, own = lo[number] + window * STEP, own[number]
    hi = np.minimum(lo + SPAN, hi[number])
    h = mix(Spans(letters, BYTES).raw(lo, hi))
    _, one, back = np.unique(h, return_index=True, return_inverse=True)
    place = lo[one][:, None] + np.arange(SPAN)
    spans = np.where(place < hi[one][:, None], letters[np.minimum(place, len(letters) - 1)], 0).astype(np.uint8)
    span, mark, value = marks.against(spans)
    # back from distinct spans to where they stand
    hits = np.bincount(span, minlength=len(one))
    order = np.argsort(span, kind="stable")
    begin_of = np.concatenate([[0], np.cumsum(hits)])
    places = np.flatnonzero(hits[back])
    times = hits[back[places]]
    entry = order[np.repeat(begin_of[back[places]], times)
                  + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    where = sentence[np.repeat(own[places], times)]
    # best span of each (sentence, landmark)
    pick = np.lexsort((-value[entry], mark[entry], where))
    where, entry = where[pick], entry[pick]
    best = np.ones(len(pick), bool)
    best[1:] = (where[1:] != where[:-1]) | (mark[entry][1:] != mark[entry][:-1])
    where, entry = where[best], entry[best]
    row_of = row[np.flatnonzero(new)]
    return row_of[where], where, mark[entry], value[entry]


def stems(words: set[bytes]) -> set[bytes]:
    """The words and their beginnings."""
    return words | {w[:k] for w in words for k in STEMS if len(w) > k}


def choose_landmarks(toxic: list[set[bytes]], clean: dict[bytes, int]) -> list[bytes]:
    """Words and beginnings that together explain the toxic documents and occur in few others."""
    holders: dict[bytes, set[int]] = {}
    for i, words in enumerate(toxic):
        for word in words:
            holders.setdefault(word, set()).add(i)
    holders = {w: d for w, d in holders.items() if len(d) >= LEAST_HOLDERS and clean.get(w, 0) <= 0.05 * len(d)}
    chosen, left = [], set(range(len(toxic)))
    strong = sorted(holders, key=lambda w: (-len(holders[w]), -len(w), w))
    gain = {w: len(holders[w]) for w in strong}
    while len(chosen) < LANDMARKS and left and strong:
        best = max(strong, key=lambda w: (gain[w], -clean.get(w, 0), len(w)))
        if gain[best] < 2:
            break
        chosen.append(best)
        left -= holders[best]
        gain = {w: len(holders[w] & left) for w in strong}
    # as pure and frequent, but not needed to explain the documents
    often = max(3, len(toxic) // 20)
    rest = [w for w in strong if len(holders[w]) >= often and not any(c.startswith(w) for c in chosen)]
    rest = [w for w in rest if not any(o.startswith(w) and o != w and holders[o] == holders[w] for o in rest)]
    return chosen + rest[:LANDMARKS - len(chosen)]


def _variants(words: list[bytes]) -> list[bytes]:
    """Each landmark alone, and longer ASCII ones with a character inserted, at three places."""
    return words + [w[:k] + b"x" + w[k:] for w in words if len(w) >= 5 and w.isascii() for k in (2, len(w) // 2, len(w) - 2)]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Linear SVM (squared hinge, bias last), by Newton steps on the rows inside the margin."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = weight / weight.sum()
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-9
    w, inside = np.zeros(x.shape[1]), np.ones(len(x), bool)
    for _ in range(rounds):
        own = x[inside] * weight[inside][:, None]
        w = np.linalg.solve(own.T @ x[inside] + np.diag(ridge), own.T @ y[inside])
        now = y * (x @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over margins, near balanced classes."""
    a, b = 1.0, 0.0
    weight = np.where(y > 0, 2 * TOXIC_WEIGHT, 1.0)
    weight /= weight.sum()
    for _ in range(3000):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d = (p - (y > 0)) * weight
        a, b = max(0.1, a - 3 * (d * margin).sum()), b - 3 * d.sum()
    return a, b


def features(roots: list[np.ndarray], k: np.ndarray) -> np.ndarray:
    """Nyström features of rows of kernel values."""
    return np.concatenate([k ** power @ root for power, root in zip(POWERS, roots, strict=True)], axis=1)


def _by_sentence(rows: tuple[np.ndarray, ...], m: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, kernel values) of each sentence with a match."""
    doc, sentence, mark, value = rows
    number, first, back = np.unique(sentence, return_index=True, return_inverse=True)
    k = np.zeros((len(number), m))
    k[back, mark] = value
    return doc[first], k


def fit(marks: Landmarks, y: np.ndarray, rows: tuple[np.ndarray, ...]) -> dict:
    """Train on (document, sentence, landmark, kernel) entries; y: -1 or 1 a document."""
    m = len(marks.words)
    if m == 0 or len(np.unique(y)) < 2:
        share = float((y > 0).mean()) if len(y) else 0.5
        return {"roots": [np.zeros((m, 0))] * len(POWERS), "svm": np.zeros(1), "slope": 1.0,
                "shift": float(np.log((share + 1e-4) / (1 - share + 1e-4)))}
    roots = []
    for power in POWERS:
        values, vectors = np.linalg.eigh(marks.gram() ** power + 1e-3 * np.eye(m))
        roots.append(vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T)
    of, k = _by_sentence(rows, m)
    x = features(roots, k)
    changed = b". ".join(_variants(marks.words))
    _, k_more = _by_sentence(sentence_kernels(np.frombuffer(changed, np.uint8), np.array([0, len(changed)]), marks), m)
    more = features(roots, k_more)
    # documents without a match: one row stands for them
    bare = max(1, int((y < 0).sum()) - len(np.unique(of[y[of] < 0])))
    score = k.sum(axis=1)
    for _ in range(5):
        order = np.lexsort((-score, of))
        top = np.ones(len(order), bool)
        top[1:] = of[order][1:] != of[order][:-1]
        witness = order[top]
        witness = witness[y[of[witness]] > 0]
        other = np.flatnonzero(y[of] < 0)
        xs = np.concatenate([x[witness], more, x[other], np.zeros((1, x.shape[1]))])
        ys = np.concatenate([np.ones(len(witness) + len(more)), -np.ones(len(other) + 1)])
        weight = np.concatenate([np.full(len(witness), TOXIC_WEIGHT),
                                 np.full(len(more), TOXIC_WEIGHT * len(witness) / max(1, len(more))), np.ones(len(other)), [bare]])
        w = _svm(xs, ys, weight)
        score = x @ w[:-1] + w[-1]
    margin = np.full(len(y), w[-1])
    np.maximum.at(margin, of, score)
    slope, shift = _calibrate(margin, y)
    return {"roots": roots, "svm": w, "slope": slope, "shift": shift}


KERNELS = "row long, sentence long, mark int, value double"


def train(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCS) -> dict:
    """Landmarks and SVM, from at most ``bound`` labelled documents."""
    rows = materialize(sample(docs, labels, "toxic", bound).withColumnRenamed("doc_id", "row"))
    words = F.array_distinct(F.split(F.lower("text"), r"[\s\p{Punct}\d]+"))
    words = F.filter(words, lambda w: F.octet_length(w).between(SHORTEST, LONGEST))
    toxic = [stems({fold(w) for w in r["words"]} - {b""}) for r in
             rows.where("label > 0").orderBy("row").select(words.alias("words")).collect()]  # at most ``bound`` documents
    held = Counter(w for own in toxic for w in own)
    wanted = {w for w, n in held.items() if n >= LEAST_HOLDERS}

    def count(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            for own in batch.column("words").to_pylist():
                for w in stems({fold(w) for w in own}) & wanted:
                    seen[w] = seen.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "n"])
    counted = rows.where("label <= 0").select(words.alias("words")).mapInArrow(count, "word binary, n long")
    clean = {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    marks = Landmarks([w for w in choose_landmarks(toxic, clean)
                       if SHORTEST <= len(w) <= LONGEST])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        row, sentence, mark, value = sentence_kernels(data, offsets, marks)
        return pa.RecordBatch.from_arrays(
            [batch.column("row").take(pa.array(row)), pa.array(sentence), pa.array(mark.astype(np.int32)),
             pa.array(value)], names=["row", "sentence", "mark", "value"])
    known = sorted(((r["row"], r["label"]) for r in rows.select("row", "label").collect()))
    number = {r: i for i, (r, _) in enumerate(known)}
    found = sorted((number[r["row"]], r["sentence"], r["mark"], r["value"])
                   for r in map_batches(rows.select("row", "text"), run, KERNELS).collect())
    entries = tuple(np.array([f[i] for f in found], np.float64 if i == 3 else np.int64) for i in range(4))
    # sentences are numbered within a batch: number them over all documents
    entries = (entries[0], entries[0] * (1 << 32) + entries[1], entries[2], entries[3])
    y = np.array([1 if label > 0 else -1 for _, label in known], np.int64)
    return fit(marks, y, entries) | {"marks": marks}


def document_scores(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of every row: its worst sentence, calibrated."""
    w = model["svm"]
    margin = np.full(len(offsets) - 1, w[-1])
    for a, b in parts(offsets):
        row, sentence, mark, value = sentence_kernels(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                                                      model["marks"])
        if not len(row):
            continue
        of, k = _by_sentence((row, sentence, mark, value), len(model["marks"].words))
        np.maximum.at(margin, a + of, features(model["roots"], k) @ w[:-1] + w[-1])
    return 1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["shift"], -30, 30)))


def scores(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = document_scores(model, *text_bytes(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())],
                                          names=["doc_id", "score"])
    return (map_batches(documents_of(docs), run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
