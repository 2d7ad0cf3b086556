import random
import unicodedata

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitboss.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def slow_merges(symbols, ranks):
    """Lowest rank first, then leftmost, by scanning all pairs every time."""
    symbols, merges = list(symbols), 0
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks), default=None)
        if best is None:
            return merges
        i = best[1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        merges += 1


def test_merging_equals_the_scan():
    ranks = tc.counter(PATH).words.ranks
    draw = random.Random(1)
    for _ in range(400):
        word = [draw.choice("abeinorst") for _ in range(draw.randint(0, 40))]
        assert tc.merge_count(word, ranks) == slow_merges(word, ranks)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text_counts_as_the_library_does(text):
    assert tc.counter(PATH).tokens(text) == library(text)


def test_every_character_counts_as_the_library_does():
    draw = random.Random(2)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    some = chars[:0x3000] + draw.sample(chars, 6000) + [c for c in chars[:0x20000] if unicodedata.category(c) == "Cn"][::17]
    for a in range(0, len(some), 50):
        text = "".join(f"a{c}1 {c}  {c}!{c}'s " for c in some[a:a + 50])
        assert tc.counter(PATH).tokens(text) == library(text)


def test_special_strings_and_long_words():
    for text in ("a<|endoftext|>b", "<|endoftext|>", " <|endoftext|>  <|endoftext|><|endoftext|> x",
                 "<|endoftext", "a" * 20_000, "ab" * 5_000, " " * 3_000, "\n" * 999 + "x", "é" * 4_000, "<|ENDOFTEXT|>"):
        assert tc.counter(PATH).tokens(text) == library(text), text[:20]
    long = "the quick brown fox, it's 12 and <|endoftext|> more. " * 30_000
    assert tc.counter(PATH).tokens(long) == library(long)


def test_the_table_of_words_stays_bounded(monkeypatch):
    monkeypatch.setattr(tc, "TABLE_WORDS", 10)
    c = tc.Counter(PATH)
    text = " ".join(f"word{i}x" for i in range(500)) + " " + "y" * 200
    assert c.tokens(text) == library(text) and len(c.words) <= 10


def test_other_vocabularies_raise():
    with pytest.raises(ValueError):
        tc.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_query_equals_the_library(spark):
    from pitboss.llm.queries import op11_token_counts

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: r for r in op11_token_counts(spark, "/root/testdata/sf0.01").collect()}
    assert len(out) == len(docs)
    for doc in docs:
        row = out[doc["doc_id"]]
        assert row["n_bytes"] == len((doc["text"] or "").encode())
        assert row["n_tokens"] == library(doc["text"]) and row["over_limit"] == (row["n_tokens"] > 1024)


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "same"), (3, "same"), (4, "word " * 1025)]
    df = make_docs(rows).withColumnRenamed("n_chars", "n_tokens").withColumnRenamed("lang", "over_limit")
    out = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"])
                  for r in tc.token_counts(df, PATH).collect()), key=str)
    assert out == sorted([(i, len((t or "").encode()), library(t), library(t) > 1024) for i, t in rows], key=str)
    assert tc.token_counts(make_docs([]), PATH).count() == 0
