import zlib

import numpy as np

from pitboss.llm import quality, toxicity


def tables(spark, sf="sf0.1"):
    read = lambda t: spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet")
    return read("documents"), read("labels")


def accuracy(out, labels, label):
    """Balanced accuracy on the held-out labels."""
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    right = {0: [], 1: []}
    for r in out.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        if r["held_out"] and r["doc_id"] in known:
            right[known[r["doc_id"]]].append(r["predicted"] == known[r["doc_id"]])
    return np.mean(right[0]), np.mean(right[1])


def test_quality_held_out(spark):
    docs, labels = tables(spark)
    low, high = accuracy(quality.scores(docs, quality.train(docs, labels)), labels, "quality")
    assert low > 0.85 and high > 0.95


def test_toxicity_held_out(spark):
    docs, labels = tables(spark)
    clean, toxic = accuracy(toxicity.scores(docs, toxicity.train(docs, labels)), labels, "toxic")
    assert clean > 0.95 and toxic > 0.85


def test_toxicity_tolerates_gaps_and_inserted_characters(spark, make_docs):
    docs, labels = tables(spark)
    model = toxicity.train(docs, labels)
    word = next(w.decode() for w in model["marks"].words if len(w) >= 7 and w.isascii())
    plain = "the of and ering that was this with by onea there. "
    forms = [word, word.upper(), word[:3] + "x" + word[3:], "-".join(word), " ".join(word), word[:4] + "**" + word[4:]]
    rows = [(0, plain * 3)] + [(k + 1, plain + f"is a {f} of the." + plain) for k, f in enumerate(forms)]
    out = {r["doc_id"]: r["predicted"] for r in toxicity.scores(make_docs(rows), model).collect()}
    assert out == {0: 0} | {k + 1: 1 for k in range(len(forms))}


def test_kernel_matches_its_definition():
    from itertools import combinations

    def plain(s, t, n=toxicity.ORDER, decay=toxicity.DECAY):
        total = 0.0
        for a in combinations(range(len(s)), n):
            for b in combinations(range(len(t)), n):
                if all(s[i] == t[j] for i, j in zip(a, b)):
                    total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
        return total
    pairs = [(b"idiot", b"idiot"), (b"idxiot", b"idiot"), (b"abcabc", b"cabac"), (b"ab", b"abc"), (b"aaaa", b"aaa")]
    s = toxicity.padded([p[0] for p in pairs], 8)
    t = toxicity.padded([p[1] for p in pairs], 8)
    want = [plain(*p) for p in pairs]
    assert np.allclose(toxicity.subsequence_kernel(s, t), want, rtol=1e-5)
    assert list(toxicity.longest_common(s, t)) == [5, 5, 4, 2, 3]


def test_attention_gradient():
    rng = np.random.default_rng(0)
    counts, x = np.array([2, 1, 3]), rng.random((6, quality.FEATURES))
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    w = quality.fit(counts, x, y, epochs=1)
    p, kept = quality.forward(w, counts, x)
    grad = quality._gradient(w, p, y, weight, kept)

    def loss(name, i, d):
        v = {k: np.array(a, float) for k, a in w.items()}
        v[name].flat[i] += d
        q, _ = quality.forward(v, counts, x)
        return -(weight * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() / weight.sum()
    for name, i in (("embed", 7), ("tanh", 3), ("gate", 5), ("attend", 2), ("out", 1), ("embed0", 4), ("out0", 0)):
        slope = (loss(name, i, 1e-5) - loss(name, i, -1e-5)) / 2e-5
        assert np.isclose(np.ravel(grad[name])[i], slope, atol=1e-6), name


def test_defined_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "some text"), (4, "x" * 20000), (4, "x" * 20000), (5, "no. stop! ok?")]
    docs = make_docs(rows).withColumnRenamed("lang", "label").withColumnRenamed("source", "score")
    some = [(i, i % 2, i % 3 // 2) for i in range(1, 6)] + [(None, 1, 1), (2, None, None), (2, 0, 1)]
    for labels in (spark.createDataFrame(some, "doc_id long, quality int, toxic int"),
                   spark.createDataFrame([], "doc_id long, quality int, toxic int")):
        for m in (quality, toxicity):
            out = m.scores(docs, m.train(docs, labels)).collect()
            assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)
            assert len({r["score"] for r in out if r["doc_id"] in (1, 2, 3)}) == 1
            assert m.scores(make_docs([]), m.train(make_docs([]), labels)).count() == 0
