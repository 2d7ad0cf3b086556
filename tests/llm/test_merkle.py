import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from pitboss.llm import merkle

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in
               (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def tree(nodes):
    """Levels of lists from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][a:a + 8]) for a in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i - i % 8
        out.append((level[a:i], level[i + 1:a + 8]))
        i //= 8
    return out


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[g] = tree([leaf(r, r["text"]) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, k)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in steps:
                node = H(*left, node, *right)
            out.append((r["doc_id"], trees[g][0][i], trees[g][-1][0], top[-1][0],
                        H(*[x for left, right in steps for x in left + right]), node, node == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.verification(df).select(*cols).collect()), key=str)


def test_query_equals_brute_force(spark):
    from pitboss.llm.queries import op13_merkle_manifest

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    out = op13_merkle_manifest(spark, "/root/testdata/sf0.01").collect()
    assert sorted((tuple(r) for r in out), key=str) == brute([r.asDict() for r in docs])
    assert {r["verified"] for r in out} == {True, False}


def test_group_sizes_around_the_fanout(spark, make_docs):
    draw = random.Random(3)
    for sizes in ([1], [1, 1], [8, 9], [7, 64, 65], [1] * 9, [513, 2]):
        rows = [(i, draw.choice(["Text", "text", "", None, "É ß"])) for i in draw.sample(range(9999), sum(sizes))]
        langs = [f"l{g}" for g, n in enumerate(sizes) for _ in range(n)]
        df = spark.createDataFrame([(i, t, lang, None if i % 5 == 0 else "s", len(t or "")) for (i, t), lang
                                    in zip(rows, langs)], make_docs([]).schema)
        assert got(df) == brute([r.asDict() for r in df.collect()])


def test_defined_cases(spark, make_docs):
    rows = [(None, "X", "de", None, None), (None, None, None, None, None), (5, "Aa", None, "s", 2),
            (5, "Aa", None, "s", 2), (5, "Bb", None, "s", 2), (6, None, "", "s", None), (7, "", "ö", "s", 0)]
    rows += [(9, "same Row", "en", "s", 8)] * 70 + [(i, "T" * 50_000, "en", "s", 1) for i in (-3, 2**40)]
    df = spark.createDataFrame(rows, make_docs([]).schema)
    for clash in ("group", "place", "n", "digest", "root", "path", "slot", "slot0", "copy", "depth", "__part"):
        df = df.withColumn(clash, F.lit("x"))
    assert got(df) == brute([r.asDict() for r in df.collect()])
    assert got(make_docs([])) == []


def test_unaltered_rows_all_verify(make_docs):
    df = make_docs([(i, f"Text {i}") for i in range(100)])
    assert merkle.manifest(df).where("folded_root <> root").count() == 0
