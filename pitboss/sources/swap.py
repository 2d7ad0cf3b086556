"""Recoverable replacement of a parquet table's content, and its stored schema.

A table is a folder of data files or partition folders.  Whatever a writer
changes goes through ``replace``:

1. the new content is written to ``_swap/<id>/new`` inside the table's folder
   (Spark readers skip names that begin with an underscore);
2. a journal, naming the entries that leave and those that come, is put beside
   it by one rename: from here on the change counts as made;
3. the leaving entries are renamed to ``_swap/<id>/old``, the new ones are
   renamed in, and the folder of the swap is deleted.

A run that dies before 2 has changed nothing; what it staged is deleted by the
next writer.  After 2, the next writer (or ``recover``) carries on where it
stopped: every move is repeated only if it has not been done, and nothing is
deleted before all moves are done.  One writer at a time may change a table.

``_common_metadata``, a parquet file without rows, holds the table's schema in
the place where Spark looks for it, so a table without any row or partition
is read by plain ``spark.read.parquet`` as an empty table.  It is swapped with
the data it describes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

CONTROL = "_swap"
JOURNAL = "journal.json"
SCHEMA = "_common_metadata"


# --------------------------------------------------------------------------- files

def fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return bool(fs.exists(p))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, with a trailing slash for folders; none for a missing folder."""
    fs, p = fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(x.getPath().getName() + ("/" if x.isDirectory() else "") for x in fs.listStatus(p))


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = fs_path(spark, source)
    _, t = fs_path(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"cannot move {source} to {target}")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = fs_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = fs_path(spark, path)
    held = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    finally:
        held.close()


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` computed once and kept on shared storage while the block runs: what
    is written from them cannot change them, and a lost executor loses nothing."""
    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/held-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        delete_path(spark, path)


# --------------------------------------------------------------------------- tables

def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative names of the partition folders ``depth`` levels down; for depth 0,
    the table's entries: data files and first-level folders."""
    if not depth:
        return [n.rstrip("/") for n in names_in(spark, path) if not _hidden(n)]
    level = [""]
    for _ in range(depth):
        level = [f"{at}{n}" for at in level for n in names_in(spark, f"{path}/{at}") if n.endswith("/") and not _hidden(n)]
    return [n.rstrip("/") for n in level]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever written at ``path`` (it may be empty by now)."""
    return bool(partition_folders(spark, path, 0)) or path_exists(spark, f"{path.rstrip('/')}/{SCHEMA}")


def read_table(spark: SparkSession, path: str, never_filled: T.StructType | None = None) -> DataFrame:
    """The table at ``path``; one that was never written is empty with the schema
    ``never_filled`` (without one, it raises as Spark does)."""
    recover(spark, path)
    if never_filled is not None and not table_exists(spark, path):
        return spark.createDataFrame([], never_filled)
    return spark.read.parquet(path)


def _stored_schema(rows: DataFrame, path: str, cols: Sequence[str], whole: bool) -> T.StructType | None:
    """Schema to store with ``rows``, None if the stored one stays right.  Columns
    that only earlier rows have stay, unless the whole content is replaced."""
    spark = rows.sparkSession
    want = {f.name: f for f in rows.schema.fields}
    known = None
    if table_exists(spark, path):
        known = spark.read.parquet(path).schema
        if not whole:
            want = {f.name: want.get(f.name, f) for f in known.fields} | want
    if known is not None and path_exists(spark, f"{path}/{SCHEMA}"):
        # the type of a partition column is read off the folder names
        plain = [{f.name: f.dataType.simpleString() for f in fields if f.name not in cols} for fields in
                 (known.fields, want.values())]
        if plain[0] == plain[1]:
            return None
    return T.StructType([T.StructField(f.name, f.dataType) for f in want.values()])


def replace(rows: DataFrame, path: str, cols: Sequence[str] = (), leaving: Sequence[str] | None = None) -> list[str]:
    """Write ``rows``, partitioned by ``cols``, in the place of the partitions
    ``leaving`` (relative folder names; None: of everything).  Partitions that
    get rows leave too.  Returns the names written."""
    spark, path = rows.sparkSession, path.rstrip("/")
    recover(spark, path)
    work = f"{path}/{CONTROL}/{uuid.uuid4().hex}"
    writer = rows.write
    (writer.partitionBy(*cols) if cols else writer).parquet(f"{work}/new")
    coming = partition_folders(spark, f"{work}/new", 0 if leaving is None else len(cols))
    going = partition_folders(spark, path, 0) if leaving is None else sorted({*leaving, *coming})
    schema = _stored_schema(rows, path, cols, leaving is None)
    swapped = list(coming)
    if schema is not None:
        spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{work}/schema")
        part = next(n for n in names_in(spark, f"{work}/schema") if not _hidden(n))
        move(spark, f"{work}/schema/{part}", f"{work}/new/{SCHEMA}")
        swapped.append(SCHEMA)
        going = [*going, SCHEMA]
    write_text(spark, f"{work}/{JOURNAL}.part", json.dumps({"going": going, "coming": swapped}))
    move(spark, f"{work}/{JOURNAL}.part", f"{work}/{JOURNAL}")
    _finish(spark, path, work)
    return coming


def _finish(spark: SparkSession, path: str, work: str) -> None:
    """Carry out the moves of a journal that have not been carried out yet."""
    plan = json.loads(read_text(spark, f"{work}/{JOURNAL}"))
    coming = set(plan["coming"])
    for name in plan["going"]:
        here, old = f"{path}/{name}", f"{work}/old/{name}"
        outdated = name not in coming or path_exists(spark, f"{work}/new/{name}")
        if outdated and path_exists(spark, here) and not path_exists(spark, old):
            move(spark, here, old)
    for name in plan["coming"]:
        if path_exists(spark, f"{work}/new/{name}"):
            move(spark, f"{work}/new/{name}", f"{path}/{name}")
    delete_path(spark, work)


def recover(spark: SparkSession, path: str) -> None:
    """Finish the swaps that were journaled, and delete what others have staged.
    Called by every writer before it reads the table."""
    path = path.rstrip("/")
    for name in names_in(spark, f"{path}/{CONTROL}"):
        work = f"{path}/{CONTROL}/{name.rstrip('/')}"
        if path_exists(spark, f"{work}/{JOURNAL}"):
            _finish(spark, path, work)
        else:
            delete_path(spark, work)
