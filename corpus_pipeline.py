"""Corpus pipeline: five stages from raw documents to token digests.

Each stage takes (spark, docs, sf_dir), calls one operator of ``pitboss.llm``
on all its predecessor kept, and returns a DataFrame; all but the last return
the columns of ``documents``.  ``run`` writes every stage's result to the
shared scratch folder as Parquet and reads it back as the next one's input.

Defined cases: rows with a null doc_id pass the filtering stages (their
operators cannot name them); repeated rows of a document that stays, stay; an
empty table runs through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitboss.llm import bpe, decontaminate, jaccard_join, quality, suffix_dedup
from pitboss.llm.common import materialize, rejoin, settle, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return rejoin(docs, quality.scores(docs, weights).where("predicted = 0"), "left_anti")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    copies = settle(spark, lambda: jaccard_join.jaccard_join(docs).where("doc_id <> component_id").select("doc_id"))
    return rejoin(docs, copies, "left_anti")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that a smaller document has are cut out of the texts; ``n_chars``
    of a changed text is its new length."""
    changed = settle(spark, lambda: suffix_dedup.suffix_dedup(docs, with_text=True).where("n_removed > 0")
                     .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"),
                             F.expr("try_validate_utf8(cast(kept AS string))").alias("__valid"),
                             F.expr("make_valid_utf8(cast(kept AS string))").alias("__kept")))
    changed = changed.dropDuplicates(["__id", "__hash"])  # one row of repeated rows
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.join(changed, (docs["doc_id"] == F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    # a cut may fall inside a character: what is left of it goes
    kept = F.coalesce("__valid", F.regexp_replace("__kept", "\ufffd", ""))
    new = {"text": F.when(F.col("__id").isNotNull(), kept).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__id").isNotNull(), F.char_length(kept)).otherwise(F.col("n_chars")) \
            .cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a test item go."""
    leaks = settle(spark, lambda: decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))
    return rejoin(docs, leaks, "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE digests of the remaining texts."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

# A trained classifier decides the first stage: no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
