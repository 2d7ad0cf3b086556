"""Readers for the raw parquet tables the adapters derive bronze shapes from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Per session and path: what the folder held when the scan was made, and the scan.
_SCANS: dict[tuple[int, str], tuple[tuple, DataFrame]] = {}


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Files, bytes and modification time under ``path`` (one metadata call each):
    a scan made from another state lists the folder again."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.getContentSummary(target)
    return held.getFileCount(), held.getLength(), fs.getFileStatus(target).getModificationTime()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan of one table; naming the columns keeps the scan pruned.

    The unprojected scan is made once per session, path and state of the
    folder (file listing and footer schema are read once); every caller
    projects its own columns from it, and Catalyst prunes each scan to the
    columns actually used.  Files that arrive later are seen by the next call."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    state = folder_state(spark, path)
    known, df = _SCANS.get(key, (None, None))
    if df is None or known != state or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _SCANS[key] = (state, df)
    return df.select(*columns) if columns else df


def forget_scans(spark: SparkSession | None = None) -> None:
    """Drop remembered scans (of one session, or all) so the next read lists files again."""
    for key in [k for k in _SCANS if spark is None or k[0] == id(spark)]:
        del _SCANS[key]
