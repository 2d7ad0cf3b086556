"""Quality classifier: gated-attention multiple-instance learning (operator 8).

A document is a bag of passages of PASSAGE_WORDS words, all of its text.  A
passage is encoded by its byte-class bigrams and word statistics (vectorised
over Arrow batches); a learned layer embeds it, gated attention
(tanh branch times sigmoid branch) weighs the passages, and the weighted sum
is scored.  Weights are learned from document labels alone, on a bounded
sample (``bound`` documents, at most FIT_PASSAGES evenly spaced passages of
each); every document is scored on all its passages.

Defined cases: a null, empty or blank text is one passage of zero features;
rows with a null doc_id are scored and not held out; repeated rows are scored
each; without any label, or with one class only, the score is that class's
share (0.5 without labels).  Labels, lang, source and doc_id are no inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of, map_batches
from .hashing import LOWER, Spans, mix, parts, text_bytes, word_spans
from .labels import held_out, sample

PASSAGE_WORDS = 64
FIT_DOCS = 4000
FIT_PASSAGES = 24
EMBED, ATTEND = 16, 8

# Byte classes: letters by case, digits, white space, kinds of punctuation.
_CLASS = np.full(256, 15, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 14
for _k, _chars in enumerate((b" \t", b"\n\r\x0b\x0c", b".", b",", b"!", b"?", b"'\"`", b"|", b"#$%&*@",
                             b"<>[]{}()", b"=/\\_~^+-:;"), 3):
    _CLASS[list(_chars)] = _k
FEATURES = 256 + 4


def encode_passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(passages per row, features of all passages, float32)."""
    data, offsets = text_bytes(column)
    counts, features = [], []
    for a, b in parts(offsets):
        at = offsets[a:b + 1] - offsets[a]
        piece = data[offsets[a]:offsets[b]]
        starts, ends, row = word_spans(piece, at)
        n_words = np.bincount(row, minlength=b - a)
        n_pass = np.maximum(1, -(-n_words // PASSAGE_WORDS))
        first_word = np.concatenate([[0], np.cumsum(n_words)])
        first_pass = np.concatenate([[0], np.cumsum(n_pass)])
        total = int(first_pass[-1])
        x = np.zeros((total, FEATURES), np.float32)
        if len(starts):
            own = first_pass[row] + (np.arange(len(starts)) - first_word[row]) // PASSAGE_WORDS
            # a byte belongs to the passage of the word that begins at or before it
            word_at = np.zeros(len(piece), np.int64)
            word_at[starts] = 1
            of_byte = own[np.maximum(np.cumsum(word_at) - 1, 0)]
            kind = _CLASS[piece]
            pair = of_byte[:-1] * 256 + kind[:-1] * 16 + kind[1:]
            grams = np.bincount(pair, minlength=total * 256).reshape(total, 256)
            x[:, :256] = np.sqrt(grams / np.maximum(1, grams.sum(axis=1, keepdims=True)))
            words = mix(Spans(piece, LOWER).raw(starts, ends))
            size = np.bincount(own, minlength=total)
            order = np.lexsort((words, own))
            new = np.ones(len(order), bool)
            new[1:] = (words[order][1:] != words[order][:-1]) | (own[order][1:] != own[order][:-1])
            distinct = np.bincount(own[order][new], minlength=total)
            same = np.bincount(own[1:][words[1:] == words[:-1]], minlength=total)
            length = np.bincount(own, weights=ends - starts, minlength=total)
            some = np.maximum(1, size)
            x[:, 256] = distinct / some
            x[:, 257] = same / some
            x[:, 258] = np.minimum(length / some, 40) / 10
            x[:, 259] = np.log1p(size) / np.log1p(PASSAGE_WORDS)
        counts.append(n_pass)
        features.append(x)
    if not counts:
        return np.zeros(0, np.int64), np.zeros((0, FEATURES), np.float32)
    return np.concatenate(counts), np.concatenate(features)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(w: dict, counts: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, dict]:
    """Score of every bag, and what the gradient needs."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    bag = np.repeat(np.arange(len(counts)), counts)
    x = (x - w["mean"]) / w["scale"]
    h = np.tanh(x @ w["embed"] + w["embed0"])
    t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
    e = (t * g) @ w["attend"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    p = _sigmoid(z @ w["out"] + w["out0"])
    return p, {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "starts": starts}


def _gradient(w: dict, p: np.ndarray, y: np.ndarray, weight: np.ndarray, k: dict) -> dict:
    d = (p - y) * weight / weight.sum()
    bag, starts, h, t, g, a = k["bag"], k["starts"], k["h"], k["t"], k["g"], k["a"]
    dz = d[:, None] * w["out"]
    da = (dz[bag] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, starts)[bag])
    dt, dg = de[:, None] * w["attend"] * g * (1 - t * t), de[:, None] * w["attend"] * t * g * (1 - g)
    dh = a[:, None] * dz[bag] + dt @ w["tanh"].T + dg @ w["gate"].T
    du = dh * (1 - h * h)
    return {"out": k["z"].T @ d, "out0": d.sum(), "attend": (t * g).T @ de, "tanh": h.T @ dt, "gate": h.T @ dg,
            "embed": k["x"].T @ du, "embed0": du.sum(axis=0)}


def fit(counts: np.ndarray, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256, seed: int = 5) -> dict:
    """Learn the weights from bags and their labels (Adam)."""
    rng = np.random.Generator(np.random.PCG64(seed))
    share = float(y.mean()) if len(y) else 0.5
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 0.02) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"mean": mean, "scale": scale, "embed": draw(FEATURES, EMBED) * 0.3, "embed0": np.zeros(EMBED),
         "tanh": draw(EMBED, ATTEND), "gate": draw(EMBED, ATTEND), "attend": draw(ATTEND), "out": draw(EMBED),
         "out0": np.float64(0)}
    if share in (0.0, 1.0) or not len(y):
        w["out"] = np.zeros(EMBED)
        w["out0"] = np.log((share + 1e-4) / (1 - share + 1e-4))
        return w
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    starts = np.concatenate([[0], np.cumsum(counts)])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items() if k not in ("mean", "scale")}
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        shuffled = rng.permutation(len(counts))
        for lo in range(0, len(shuffled), batch):
            some = shuffled[lo:lo + batch]
            rows = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in some])
            p, kept = forward(w, counts[some], x[rows].astype(np.float64))
            grad = _gradient(w, p, y[some], weight[some], kept)
            step += 1
            for name, (m, v) in moments.items():
                gr = grad[name] + (1e-4 * w[name] if np.ndim(w[name]) == 2 else 0)
                m = 0.9 * m + 0.1 * gr
                v = 0.99 * v + 0.01 * gr * gr
                moments[name] = (m, v)
                w[name] = w[name] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def _bags(rows: DataFrame) -> DataFrame:
    """Passage features of the sample, at most FIT_PASSAGES of each document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, x = encode_passages(batch.column("text"))
        starts = np.concatenate([[0], np.cumsum(counts)])
        taken = [np.unique(np.linspace(starts[i], starts[i + 1] - 1, min(n, FIT_PASSAGES)).astype(int))
                 for i, n in enumerate(counts)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([x[t].tobytes() for t in taken], pa.binary())],
            names=["doc_id", "label", "x"])
    return map_batches(rows, run, "doc_id long, label int, x binary")


def train(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCS) -> dict:
    """Weights learned from at most ``bound`` labelled documents."""
    bags = sorted(_bags(sample(docs, labels, "quality", bound)).collect(), key=lambda r: (r["doc_id"], r["x"]))
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in bags]
    return fit(np.array([len(v) for v in x], np.int64), np.concatenate(x) if x else np.zeros((0, FEATURES), np.float32),
               np.array([r["label"] > 0 for r in bags], np.float64))


def scores(docs: DataFrame, weights: dict, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, x = encode_passages(batch.column("text"))
        p, _ = forward(weights, counts, x)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())],
                                          names=["doc_id", "score"])
    return (map_batches(documents_of(docs), run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
