"""Spark session settings the library relies on.

The library never creates a session behind the caller's back: every public
function takes a ``SparkSession`` (or DataFrames).  ``build_session`` is the
builder used by tests, the bench and local runs; on a cluster the operator's
own session is used as-is and only ``ensure_checkpoint_dir`` is applied.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library assumes.  They are semantic (UTC, ANSI)
# or scale-related (AQE, dynamic partition overwrite); none of them caps data.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension joins are left to the planner: it broadcasts a side only when
    # its measured size is below this threshold and falls back to a shuffled
    # join beyond it, so no data-dependent table is broadcast unchecked.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Tables without a day column (money rows, session details, detail chips)
    # are joined to one day's keys: a runtime bloom filter built from the small
    # side pre-filters the large side before its shuffle.  Spark builds one from
    # sides of up to 10 MB by default, which are broadcast anyway; the limit is
    # set above the broadcast threshold, so that larger key sets prune too.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(256 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pitboss") -> SparkSession:
    """Local/test session: UI off, UTC, ANSI, AQE, small shuffle fan-out."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PITBOSS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.default.parallelism", str(shuffle_partitions or int(cpus)))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is read as given (and
    is required).  Only in local mode, when it is unset (tests), a fresh local
    folder is made and set.
    """
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
               or spark.sparkContext.getCheckpointDir())
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        # On a cluster a machine-local folder is not visible to the executors
        # and disappears with the driver: the shared folder must be configured.
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (e.g. on HDFS or object "
                           "storage) in the session configuration")
    local = tempfile.mkdtemp(prefix="pitboss-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def apply_conf(spark: SparkSession) -> None:
    """Apply the settings to an existing session.  All of them can be set at run
    time; a session that refuses one raises, since its results would differ."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
               min_partitions: int = 200) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of (compressed) input.

    Scan splits and the initial shuffle fan-out are sized so one partition is
    about ``target_partition_bytes``; AQE then coalesces small shuffle
    partitions towards half of it and splits skewed ones.  At 100 TB with the
    default target this gives ~400,000 initial shuffle partitions, which AQE
    reduces per stage to what the stage's real output needs.  Apply with
    ``for k, v in scale_conf(n).items(): spark.conf.set(k, v)``."""
    parts = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
