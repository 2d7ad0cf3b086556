import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def small(spark):
    """The 200 smallest doc_ids of the small test tables, as (doc_id, text)."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)
