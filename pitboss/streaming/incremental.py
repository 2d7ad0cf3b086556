"""Incremental ingest as a Structured Streaming job (watermark extract + keyed upsert).

The batch loader keeps a text high-water mark per source.  The streaming form
lets Spark track progress instead: a file-source stream over the landing
folder, ``trigger(availableNow=True)`` to process everything that arrived and
stop, and ``foreachBatch`` to apply the keyed last-wins upsert to the target.

* Progress and exactly-once bookkeeping live in the streaming checkpoint,
  placed under the shared ``spark.checkpoint.dir`` unless given.
* A micro-batch may be replayed after a failure; the upsert is idempotent
  (last row per key by sequence), so a replay leaves the same table.
* With ``partition_by`` only the partitions a batch touches are rewritten;
  the rebuilt partitions are checkpointed before their files are replaced,
  since they are computed from those same files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources.sinks import write_upsert


def incremental_upsert(spark: SparkSession, source_path: str, schema: T.StructType, target_path: str,
                       key: Sequence[str], seq: str, checkpoint_location: str | None = None,
                       partition_by: Sequence[str] = (), max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an available-now stream that upserts new landing files into the target."""
    base = ensure_checkpoint_dir(spark)
    ckpt = checkpoint_location or f"{base.rstrip('/')}/streams/{target_path.strip('/').replace('/', '_')}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)
    return (stream.writeStream
            .foreachBatch(lambda df, _epoch: write_upsert(df, target_path, key, F.col(seq), partition_by))
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start())
