import zlib

import numpy as np

from pitboss.llm import hilbert


def test_curve_visits_every_point_by_unit_steps():
    for n, bits in ((2, 4), (3, 3)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        index = hilbert.hilbert_index(points, bits)
        assert sorted(index) == list(range(len(points)))
        walk = points[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(rows, out, n=40):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text_crc32"]) for r in out) == sorted(
        (i is None, i or 0, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = [sum(r["shard"] == s for r in out) for s in range(n)]
    assert max(counts) - min(counts) <= 1
    for s in range(n):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(counts[s]))
    assert {r["law"] for r in out} == {"rows"} and {r["grown_shard"] for r in out} == {None}
    assert all(r["size"] == 16 for r in out if r["text_crc32"] == 0)


def test_law_and_slots(make_docs, small):
    out = hilbert.shards(make_docs(small)).collect()
    check(small, out)
    for r in out:
        assert r["size"] == len(dict(small)[r["doc_id"]].encode()) + 16


def test_shards_are_boxes_of_the_dimensions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = hilbert.shards(docs).join(docs.select("doc_id", "lang", "source"), "doc_id").collect()
    langs = [len({r["lang"] for r in out if r["shard"] == s}) for s in range(40)]
    sources = [len({r["source"] for r in out if r["shard"] == s}) for s in range(40)]
    assert sum(langs) / 40 < 2 and sum(sources) / 40 < 15  # of 4 and 20


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (None, "x"), (None, None)] + [(9, "same")] * 50 + [(i, "copy") for i in range(100, 150)]
    df = make_docs(rows).withColumnRenamed("n_chars", "place")
    out = hilbert.shards(df).collect()
    check(rows, out)
    order = sorted((r["shard"], r["slot"], r["text_crc32"]) for r in out)
    crcs = [c for _, _, c in order]
    assert sum(a != b for a, b in zip(crcs, crcs[1:])) == len(set(crcs)) - 1  # equal texts stand together
    assert hilbert.shards(make_docs([])).count() == 0
