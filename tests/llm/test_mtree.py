import math
import random

from pitboss.llm import mtree


def brute(rows, k=20, every=20):
    vec = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vec.append((i, [math.floor(64 * x) for x in v]))
    out = []
    for q, (i, v) in enumerate(vec):
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vec if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def result(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")


def test_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert result(mtree.top_k(table(spark, rows))) == brute(rows)


def test_many_pages_subtrees_and_ties(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "SUBTREE", 60)
    monkeypatch.setattr(mtree, "BLOCK", 7)
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) + 3 * (i % 3) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(200)]  # a third of all rows is one vector
    assert result(mtree.top_k(table(spark, rows))) == brute(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (None, [1.0, 1.0]),
            (1, [1.0]), (2, [0.5, -1.0, 3.0]), (3, []), (100, [-0.01, 0.01])]
    assert result(mtree.top_k(table(spark, rows))) == brute(rows)
    assert mtree.top_k(table(spark, [])).count() == 0
    assert mtree.top_k(table(spark, [(0, [1.0])])).count() == 0
    twice = result(mtree.top_k(table(spark, [(0, [1.0, 0.0]), (5, [2.0, 1.0]), (5, [2.0, 1.0])])))
    assert twice == [(0, 1, 5, 8192), (0, 2, 5, 8192)]


def test_components_of_any_size(spark):
    """Scores beyond 53 bits, beyond 62 bits and beyond a long, in one table or apart."""
    rnd = random.Random(8)
    for size in (3e6, 1e8, 1e30, 3e38):
        rows = [(i, [rnd.choice([-1, 1]) * rnd.random() * size for _ in range(5)]) for i in range(60)]
        rows += [(100 + i, [rnd.gauss(0, 1) for _ in range(5)]) for i in range(30)] + [(200, [0.0] * 5)]
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
        top = 2 ** 63 - 1
        want = []
        for q, (i, v) in enumerate(rows):
            if i % 20 == 0:
                scored = sorted((-max(-top + 1, min(top, s)), j) for j, s in (
                    (j, sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(v, w))) for j, w in rows if j != i))
                want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:20])]
        assert result(mtree.top_k(df)) == sorted(want), size


def test_clusters_are_pruned_before_they_are_searched(spark, monkeypatch):
    """Far clusters of the upper tree become no (query, subtree) rows, and no distance is computed for most."""
    monkeypatch.setattr(mtree, "SUBTREE", 50)
    rnd = random.Random(9)
    centres = [[rnd.gauss(0, 40) for _ in range(4)] for _ in range(20)]
    rows = [(i, [c + rnd.gauss(0, 0.2) for c in centres[i % 20]]) for i in range(3000)]
    import numpy as np
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float))
    unit = 2.0 ** -math.ceil(math.log2(np.abs(x).max()))
    bound = ((x * unit) ** 2).sum(axis=1).max() * (1 + 1e-12)
    upper = mtree.Upper(mtree.lift(x[:240] * unit, bound), 60)
    leaf, far = upper.place(mtree.lift(x * unit, bound))
    depth = far.shape[1]
    upper.measure({n: far[leaf == n].max(axis=0).tolist() for n in set(leaf.tolist())})
    upper.radius += 1e-7 * math.sqrt(bound)
    q = x[::20] * unit
    scores = q @ (x * unit).T
    floor = np.sort(scores, axis=1)[:, -21]
    row, kept, computed = upper.within(q, mtree.reach_of((q ** 2).sum(axis=1), bound, floor))
    pairs = set(zip(row.tolist(), kept.tolist()))
    need = {(i, int(leaf[j])) for i in range(len(q)) for j in np.flatnonzero(scores[i] >= floor[i])}
    assert need <= pairs and depth >= 1
    assert len(pairs) < 0.5 * len(q) * len(upper.paths) and computed < 0.8 * len(q) * len(upper.routing)
    assert result(mtree.top_k(table(spark, rows))) == brute(rows)


def test_clashing_columns(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(50)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, copy int")
    for name in ("part", "leaf", "far", "vector", "floor", "block", "score", "rank", "query_id", "n"):
        df = df.withColumn(name, df["copy"])
    assert result(mtree.top_k(df)) == brute(rows)
