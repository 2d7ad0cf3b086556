import random

from pitboss.llm import jaccard_join as op

from .brute import jaccard_components


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_matches_brute_force(make_docs, small):
    assert result(op.jaccard_join(make_docs(small))) == jaccard_components(small)


def test_edited_copies(make_docs):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for family in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 5, 8, 40, 120]))]
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(base) // 18))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            if rnd.random() < 0.3:
                copy = copy[:max(1, int(len(copy) * rnd.uniform(0.7, 1)))]
            rows.append((n * 3, rnd.choice([" ", "  ", "\n", "\t"]).join(copy).upper() if n % 5 == 0 else " ".join(copy)))
            n += 1
    # a chain of near copies around nothing, and a common passage in unlike texts
    chain = [f"c{i}" for i in range(60)]
    for k in range(8):
        rows.append((2000 + k, " ".join(chain[k * 3:k * 3 + 40])))
    passage = " ".join(f"p{i}" for i in range(20))
    rows += [(3000 + k, " ".join(rnd.choice(words) for _ in range(60)) + " " + passage) for k in range(10)]
    assert result(op.jaccard_join(make_docs(rows))) == jaccard_components(rows)


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "a b c d e f"),
            (6, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f")]
    df = make_docs(rows).withColumnRenamed("lang", "node").withColumnRenamed("source", "label")
    out = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"])
                  for r in op.jaccard_join(df).collect()), key=str)
    assert out == sorted([(False, 1, 0, 1), (False, 2, 0, 2), (False, 3, 0, 3), (False, 4, 1, 4), (False, 5, 1, 4),
                          (False, 6, 2, 6), (False, 6, 2, 6), (False, 7, 2, 6), (True, 0, 2, None)], key=str)
    assert op.jaccard_join(make_docs([])).count() == 0
