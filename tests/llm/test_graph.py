import random

import pytest

from pitboss.llm import common, graph, jaccard_join


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 64 partitions that stay 64: what a small table must not become files of."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def least_labels(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    ends = {x for a, b in edges if a != b for x in (a, b)}
    return {x: find(x) for x in ends}


def test_components_of_a_small_graph_are_few_files(spark, many_partitions):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)]
    edges += [(7, 7), (5000, 5000), (6001, 6000), (6000, 6001)]
    out = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["label"] for r in out.collect()} == least_labels(edges)
    assert len(out.inputFiles()) == 1
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_table_is_dealt_by_its_size(spark):
    df = spark.range(100).repartition(8)
    dealt = [common.by_size(df, n, 10).rdd.getNumPartitions() for n in (0, 1, 10, 11, 79, 100, 10**12)]
    assert dealt == [1, 1, 1, 2, 8, 8, 8]
    assert sorted(r["id"] for r in common.by_size(df, 25, 10).collect()) == list(range(100))


def test_scratch_tables_of_a_small_join_are_few_files(make_docs, many_partitions, monkeypatch):
    files = []

    def counted(df):
        files.append(len((out := common.materialize(df)).inputFiles()))
        return out
    monkeypatch.setattr(graph, "materialize", counted)
    monkeypatch.setattr(jaccard_join, "materialize", counted)
    texts = [[f"w{k}_{i}" for i in range(60)] for k in range(60)]
    rows = [(k * 10 + c, " ".join([*words[:-1], f"end{c}"])) for k, words in enumerate(texts) for c in range(3)]
    out = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(make_docs(rows)).collect()}
    assert out == {i: i // 10 * 10 for i, _ in rows}
    # sets by chunk and new pairs by key are written as the shuffle deals them
    assert sorted(files)[:-4] == [1] * (len(files) - 4)
