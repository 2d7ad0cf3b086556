import random

from pitboss.llm import decontaminate as op

ITEMS = "item_id long, text string"


def found(spark, make_docs, rows, items):
    out = op.overlaps(make_docs(rows), spark.createDataFrame(items, ITEMS)).collect()
    return {(r["doc_id"], r["item_id"]): r for r in out}


def test_plants_with_substitutions_and_clean_documents(spark, make_docs):
    rnd = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("ten", "sor", "vil", "dam", "gor", "hes")]
    prose = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [(k, " ".join(prose(rnd.randrange(18, 50)))) for k in range(30)]
    rows, want = [], set()
    for k in range(60):
        rows.append((k, " ".join(prose(200))))
    for k, (item, text) in enumerate(items):
        own = text.split()
        for p in range(4, len(own), 9):  # every ninth token another
            own[p] = "zzz"
        body = prose(80)
        at = rnd.randrange(len(body))
        rows.append((100 + k, (" ".join(body[:at]) + " " + " ".join(own).upper() + ". " + ",".join(body[at:]))))
        want.add((100 + k, item))
    assert set(found(spark, make_docs, rows, items)) == want


def test_test_tables_against_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    out = {(r["doc_id"], r["item_id"]) for r in op.overlaps(docs, items).collect()}
    plain = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if i["text"] in d["text"]}
    assert plain and plain <= out


def test_defined_cases(spark, make_docs):
    long = " ".join(f"t{k}" for k in range(30))
    items = [(1, long), (2, None), (3, ""), (4, "one two three four"), (5, "alpha beta gamma delta epsilon zeta"),
             (6, long), (None, long)]
    rows = [(1, long), (2, None), (3, ""), (4, "one two three four"), (5, "x alpha beta gamma delta epsilon zeta y"),
            (None, long), (7, " ".join(f"t{k}" for k in range(8, 22))), (8, long.replace("t12", "other")), (8, long),
            (9, "t1 " * 400), (10, ("filler words here " * 300) + long)]
    df = make_docs(rows).withColumnRenamed("lang", "hash").withColumnRenamed("source", "item_id")
    out = op.overlaps(df, spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {
        (d, i) for d in (1, None, 7, 8, 10) for i in (1, 6, None)} | {(5, 5)}
    assert op.overlaps(make_docs([]), spark.createDataFrame(items, ITEMS)).count() == 0
    assert op.overlaps(make_docs(rows), spark.createDataFrame([], ITEMS)).count() == 0
