import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from pitboss.llm import lattice_lm as op
from pitboss.llm.common import documents_of

from .brute import WORDS, lower

MODEL = P.path("piece_bpe_32k.model")


def base(rows):
    train = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(WORDS.findall(lower(t or "")) + ["\n"])
    n, v = sum(train.values()), len(train)
    out = {}
    for i, t in rows:
        tokens = WORDS.findall(lower(t or "")) + ["\n"]
        out[i] = (len(tokens), sum(train[w] > 0 for w in tokens), n,
                  sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens))
    return out


def test_counts_and_base_score(make_docs, small):
    rows = [*small, (1000, None), (1001, ""), (1002, "Ünï ☃ " * 5), (1003, "y" * 3000), (None, "never learned")]
    out = op.score(make_docs(rows), MODEL).collect()
    want = base(rows)
    assert len(out) == len(rows)
    for r in out:
        n, known, total, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], score, rel_tol=1e-9)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_lattice_sums_all_segmentations():
    first, inner = [b"", b"a", b"ab", b"abc"], [b"a", b"b", b"c", b"bc", b"ca"]
    pieces = op.Pieces(first, inner)
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.dirichlet(np.ones(len(first))), rng.dirichlet(np.ones(len(inner) + 1))])
    words = [b"a", b"abc", b"abcab", b"bca", b"abcabcabca"]

    def paths(w):
        total, uses = 0.0, Counter()

        def walk(at, chance, used):
            nonlocal total
            if at == len(w):
                total += chance * p[-1]
                for u in used:
                    uses[u] += chance * p[-1]
            for k, x in enumerate(inner):
                if w.startswith(x, at):
                    walk(at + len(x), chance * p[len(first) + k], [*used, len(first) + k])
        for k, x in enumerate(first):
            if w.startswith(x):
                walk(len(x), p[k], [k])
        return total, {u: n / total for u, n in uses.items()}
    blob = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    lattice = op.Lattice(blob, ends - [len(w) for w in words], ends, pieces)
    assert np.allclose(lattice.likelihood(np.log(p)), [math.log(paths(w)[0]) for w in words])
    count = np.array([1.0, 2.0, 1.0, 3.0, 1.0])
    want = np.zeros(pieces.size)
    for w, c in zip(words, count):
        for u, n in paths(w)[1].items():
            want[u] += c * n
    want[-1] = count.sum()
    assert np.allclose(lattice.expected(np.log(p), count), want)


def test_long_words_stay_finite():
    first, inner, fr, ir = op.read_vocabulary(MODEL)
    pieces = op.Pieces(first, inner)
    blob = np.frombuffer(b"q" * 5000, np.uint8)
    lattice = op.Lattice(blob, np.array([0]), np.array([5000]), pieces)
    assert np.isfinite(lattice.likelihood(np.log(op.prior_of(fr, ir)))).all()


def test_learning_helps_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bits = {}
    for rounds in (0, 2):
        out = op.score(docs, MODEL, rounds).where("held_out").groupBy().sum("score", "n_tokens").first()
        bits[rounds] = out[0] / out[1]
    assert bits[2] > bits[0] + 0.02


def test_empty_table_and_no_training(make_docs):
    assert op.score(make_docs([]), MODEL).count() == 0
    out = op.score(make_docs([(None, "a b"), (None, None)]).withColumnRenamed("lang", "words"), MODEL).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out) == [(1, 0, 0), (3, 0, 0)]


def test_classes_come_from_all_training_documents(make_docs, spark):
    """Documents of other letters, all behind the 2,000 first in the order of their ids' hashes, get a class."""
    rnd = random.Random(4)
    common, rare = (["".join(rnd.choice(letters) for _ in range(6)) for _ in range(20)] for letters in ("abcdefg", "tuvwxyz"))
    ids = spark.range(4000).where(F.crc32(F.col("id").cast("string").cast("binary")) % 7 != 2)
    ids = [r["id"] for r in ids.orderBy(F.xxhash64("id"), "id").limit(2240).collect()]
    rows = [(i, " ".join(rnd.choice(rare if k >= 2200 else common) for _ in range(25))) for k, i in enumerate(ids)]
    out = {r["doc_id"]: r for r in op.score(make_docs(rows), MODEL, 1).collect()}
    assert len(out) == len(rows)
    # 20 words are equally likely in their own class; in one class with others they are rarer
    for i in ids[2200:]:
        assert out[i]["score"] / out[i]["n_tokens"] > -1.5
    assert all(r["train_tokens"] == 26 * len(rows) for r in out.values())


def test_profiles_of_equal_and_empty_documents(make_docs, spark):
    for texts in (["a b"] * 4 + [None], ["", None], []):
        docs = documents_of(make_docs(list(enumerate(texts))))
        profiles = op.fit_classes(op.pair_counts(docs))
        assert len(profiles) == max(1, sum(bool(t) for t in texts))
        assert np.allclose(np.exp(profiles).sum(axis=1), 1)
