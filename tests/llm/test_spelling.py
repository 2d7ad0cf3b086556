import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pitboss.llm import spelling as sp


def brute_words(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def cuts(word):
    return {word[:i] + word[i + 1:] for i in range(len(word))}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return a in cuts(b)


def brute_near(words):
    """All pairs one edit apart, by the words that share a cut."""
    groups = {}
    for w in words:
        for c in cuts(w) | {w}:
            groups.setdefault(c, set()).add(w)
    return {p for g in groups.values() for a, b in combinations(sorted(g), 2) if one_edit(a, b) for p in ((a, b), (b, a))}


def brute(rows):
    n = brute_words(rows)
    near = {}
    for a, b in brute_near(n):
        near.setdefault(a, set()).add(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x))
        if n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n[w], len(near.get(w, ())), n[f] if f else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in sp.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_brute_force(spark, sf):
    from pitboss.llm.queries import op12_spelling_variants

    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    out = op12_spelling_variants(spark, f"/root/testdata/{sf}").collect()
    want = brute([tuple(r) for r in docs])
    assert sorted(tuple(r) for r in out) == want
    assert any(w[1] for w in want)


def test_pivots_are_the_lightest_disjoint_pair():
    draw = random.Random(4)
    for _ in range(500):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(4, 12)))
        counts = {a + b: draw.randint(1, 9) for a in "abc" for b in "abc"}
        places, last = sp.prefix(word, counts)
        assert len(places) >= 3 and all(g <= last for g, _ in places)
        chosen = sp.pivots(places)
        assert abs(chosen[0][1] - chosen[1][1]) >= 2
        assert sum(g[0] for g, _ in chosen) == min(a[0][0] + b[0][0] for a, b in combinations(places, 2)
                                                   if abs(a[1] - b[1]) >= 2)


def test_every_edit_of_few_letters_is_found(spark):
    """Words of two letters: bigrams repeat, tie and overlap as much as they can."""
    draw = random.Random(5)
    words = {"".join(draw.choice("ab") for _ in range(draw.randint(6, 9))) for _ in range(400)}
    words |= {"".join(draw.choice("abcé") for _ in range(draw.randint(6, 8))) for _ in range(1500)}
    found = sp.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert {tuple(r) for r in found} == brute_near(words) and len(found) == len(brute_near(words))


def test_chains_end_at_their_roots(make_docs):
    # abcdef <- abcdefg <- abcdefgh <- abcdefghi <- abcdefghij, each five times as frequent
    texts = [("abcdefghij"[:6 + k] + " ") * 5 * 5 ** k for k in range(5)]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = {r[0]: r for r in got(make_docs(rows))}
    assert got(make_docs(rows)) == brute(rows)
    assert out["abcdef"][2] == "abcdefghij" and out["abcdefghij"][1] is None


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (None, "Straße STRASSE Straße " * 6), (3, "ÀÉÎõüÿ×÷ " * 5), (3, "ÀÉÎõüÿ×÷ " * 5),
            (4, "ÀÉÎõüÿ× àéîõüÿ " * 5), (5, "x" * 300_000), (6, ("y" * 20_000 + " ") * 5), (10, ("y" * 20_001 + " ") * 30), (7, "中文 Привет " * 9),
            (8, "colour Colour, color; colors " * 40), (9, "a1bcdefg_hijklmn " * 5)]
    df = make_docs(rows)
    for clash in ("word", "n", "form", "root", "part", "length", "a", "b", "__near"):
        df = df.withColumn(clash, F.lit("x"))
    assert got(df) == brute(rows)
    assert got(make_docs([])) == []


def test_long_texts_and_full_tables(make_docs, monkeypatch):
    monkeypatch.setattr(sp, "LIST_BYTES", 100)
    monkeypatch.setattr(sp, "HELD_WORDS", 3)
    rows = [(i, "several different words, several Words and differant wordes " * 7) for i in range(60)]
    assert got(make_docs(rows)) == brute(rows)
