"""Labelled training samples for the classifiers.

Rows whose crc32(doc_id as text) mod 5 is 0 are held out: their labels are
never read.  The sample is the labelled documents with the least hash of
doc_id, at most ``bound`` of them: the documented bound of what a classifier
is fitted on.  Scores always cover every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents_of

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled training documents.

    A doc_id with several labels counts as 1 if any of them is; null ids and
    null labels are left out; equal texts are taken once."""
    known = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col(label).cast("int").alias("label"))
             .where(F.col("__id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("__id")))
             .groupBy("__id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("__id"), "__id").limit(bound))
    texts = documents_of(docs)
    return (texts.join(F.broadcast(known), texts["doc_id"] == F.col("__id"))  # at most ``bound`` rows
            .groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label")))
