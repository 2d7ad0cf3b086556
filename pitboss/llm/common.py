"""Helpers shared by the text operators: tables, scratch tables, Arrow batches.

Every operator reads ``documents`` through Spark (never through local files),
keeps its intermediate tables in the shared folder named by
``spark.checkpoint.dir`` and works on Arrow batches of bounded size inside
tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitboss.session import ensure_checkpoint_dir

# Rows and bytes of one Arrow batch handed to a task.  Texts can be long, so
# the default of 10,000 rows would let a batch grow to gigabytes.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20
# Rows of numbers that one task writes, see ``by_size``.
TASK_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Session settings of the text operators: bounded Arrow batches, and a
    query's shuffle files go when the query ends (results that are used again
    are written tables, see ``materialize``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


# Scratch tables of this driver, in the order they were written.
_scratch: list[str] = []


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage like a checkpoint, but the plan runs once (an RDD
    checkpoint computes its last stage twice) and a lost executor loses
    nothing.  The table is deleted when the driver's JVM ends, or by ``settle``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    fs, target = _hadoop_path(spark, path)
    fs.deleteOnExit(target)
    _scratch.append(path)
    return spark.read.schema(schema).parquet(path)


def by_size(df: DataFrame, size: int, a_task: int = TASK_ROWS) -> DataFrame:
    """``df``, which has at most ``size`` rows (or bytes), in tasks of ``a_task`` of them.

    A file has a fixed price, a process that its writer's JVM starts included
    (Hadoop's local file system sets permissions by chmod): a shuffle's default
    number of partitions is too many for a table of a few thousand rows.  Never
    makes more partitions than ``df`` has."""
    return df.coalesce(min(max(1, math.ceil(size / a_task)), (1 << 31) - 1))


def settle(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """Materialise what ``build`` returns, then delete the scratch tables that
    were written on the way to it."""
    before = len(_scratch)
    result = materialize(build())
    for path in _scratch[before:-1]:
        fs, target = _hadoop_path(spark, path)
        fs.delete(target, True)
    del _scratch[before:-1]
    return result


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``; it may return None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of ``docs``; a null text is the empty text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def rejoin(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``docs`` with ``ids(doc_id)``; a null doc_id matches nothing."""
    keys = ids.select(F.col("doc_id").alias("__join_id")).distinct()
    return docs.join(keys, docs["doc_id"] == F.col("__join_id"), how)
