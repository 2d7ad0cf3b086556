import random

from pitboss.llm import suffix_dedup as op

from .brute import suffix_dedup


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_matches_brute_force(make_docs, small):
    assert result(op.suffix_dedup(make_docs(small))) == suffix_dedup(small)


def test_planted_copies_many_chunks(make_docs, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_BYTES", 4000)
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abc ") for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 120, 400)]
    rows = []
    for i in range(60):
        body = text(rnd.randrange(0, 300))
        for s in rnd.sample(shared, 2):
            body += s[rnd.randrange(0, 3):] + text(rnd.randrange(0, 30))
        rows.append((i * 7, body))
    rows += [(1000, rows[3][1]), (1001, rows[3][1] + "x"), (1002, "x" * 500), (1003, "y" + "x" * 300 + "é" * 60)]
    assert result(op.suffix_dedup(make_docs(rows))) == suffix_dedup(rows)


def test_defined_cases(make_docs, spark):
    long = "the same words again and again, " * 4
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (None, long), (5, long), (5, long), (6, "é" * 40)]
    df = make_docs(rows).withColumnRenamed("lang", "chunk").withColumnRenamed("source", "bucket")
    out = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in op.suffix_dedup(df).collect())
    assert out == [(False, 1, 0), (False, 2, 0), (False, 3, 0), (False, 4, 0), (False, 5, len(long)),
                   (False, 5, len(long)), (False, 6, 0), (True, 0, 0)]
    assert op.suffix_dedup(make_docs([])).count() == 0
    kept = op.suffix_dedup(make_docs(rows), with_text=True).where("doc_id = 4").first()["kept"]
    assert bytes(kept) == long.encode()
