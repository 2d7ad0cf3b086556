import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from pitboss.llm import bpe, queries

from . import brute


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    import __spark_entry__
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_stages_against_brute_force(spark, make_docs, small, tmp_path):
    """Each stage on its own input; the classifier's decisions are taken as they are."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_classifier"](spark, docs, sf)
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() <= docs.count()
    rows = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    once = stages["ngram_jaccard_join"](spark, kept, sf)
    groups = brute.jaccard_components(rows)
    left = {i: t for i, t in rows if groups[i][1] == i}
    assert {r["doc_id"]: r["text"] for r in once.collect()} == left
    cut = stages["suffix_array_dedup"](spark, once, sf)
    want = brute.suffix_dedup(sorted(left.items()))
    for r in cut.collect():
        n, removed, _, sha = want[r["doc_id"]]
        if removed == 0:
            assert r["text"] == left[r["doc_id"]]
        elif len(r["text"].encode()) == n - removed:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == sha
        else:
            assert n - removed - 6 * want[r["doc_id"]][2] <= len(r["text"].encode()) < n - removed
        assert r["n_chars"] == len(r["text"])
    clean = stages["benchmark_decontamination"](spark, cut, sf)
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts and not any(i in t for t in texts.values() for i in items)
    assert clean.columns == docs.columns
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
    assert {r["doc_id"]: r["n_tokens"] for r in stages["byte_bpe"](spark, clean, sf).collect()} == {
        i: len(enc.encode_ordinary(t)) for i, t in texts.items()}


@pytest.mark.parametrize("rows", [[], [(1, None), (1, None), (None, "x"), (2, "")]])
def test_stages_on_odd_tables(spark, make_docs, rows):
    sf = "/root/testdata/sf0.001"
    docs = make_docs(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() <= len(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
