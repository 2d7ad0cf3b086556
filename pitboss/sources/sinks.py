"""Table maintenance: date-range refresh, agent-scoped refresh, full refresh,
archive/purge, schema conform.  Parquet tables partitioned by day.

Parquet has no DELETE or MERGE, so every maintenance step is a partition
rewrite through ``swap.replace``: the new content of the affected partitions is
written once beside the table (the plan runs once, and may read the table
itself), then takes the place of the affected partition folders.  An affected
partition without new rows is removed.  A run that fails at any step is
repeated whole: before the swap the table is as it was, during it the repeat
finishes the swap first.  A table that has become empty stays readable.

* **range refresh** (A17): the affected partitions are the days of the range;
* **scoped refresh** (A18): the same days, rebuilt as (old rows outside the
  scope and not re-keyed) + (new rows);
* **upsert** (A7): the partitions of the batch's rows, and those that hold
  rows of its keys;
* **full refresh** (A19): everything;
* **archive/purge** (A23): the partitions that hold rows before the cutoff;
  the rows leave for a per-cutoff archive folder first.

A NULL partition value is a partition like any other.

The ``*_state`` functions return the resulting table state as a DataFrame
(used by the named queries and the tests); the ``write_*`` functions apply it
to storage.  Only bounded metadata reaches the driver: partition values and
one count row per table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import day_between
from . import swap

ARCHIVE_MODES = ("archive_delete", "delete_only")


# --------------------------------------------------------------------------- states

def refresh_range_state(old: DataFrame, new: DataFrame, day_col: str, f, t) -> DataFrame:
    """Delete the day range, insert the recomputed range."""
    keep = old.filter(~day_between(day_col, f, t) | F.col(day_col).isNull())
    return keep.unionByName(new.filter(day_between(day_col, f, t)))


def refresh_scoped_state(old: DataFrame, new: DataFrame, day_col: str, f, t, scope_col: str, scope_value,
                         key: Sequence[str]) -> DataFrame:
    """Agent-scoped refresh (A18): delete (range AND scope), insert the new rows
    of the same scope.  Old rows whose key is re-inserted are removed as well,
    so a row whose scope value changed cannot leave two rows for one key."""
    in_scope_new = new.filter(day_between(day_col, f, t) & (F.col(scope_col) == F.lit(scope_value)))
    old_in_scope = day_between(day_col, f, t) & (F.col(scope_col) == F.lit(scope_value))
    keep = old.filter(~F.coalesce(old_in_scope, F.lit(False)))
    keep = keep.join(in_scope_new.select(*key), list(key), "left_anti")
    return keep.unionByName(in_scope_new)


def full_refresh_state(new: DataFrame) -> DataFrame:
    """Truncate + insert."""
    return new


def archive_purge_counts(tables: Mapping[str, tuple[DataFrame, Column]], cutoff: dt.date, mode: str) -> DataFrame:
    """One row per table ``(table_name, archived_rows, deleted_rows)`` (A23):
    rows strictly before ``cutoff`` leave the table (a NULL day stays); they are
    archived first in ``archive_delete`` mode."""
    if mode not in ARCHIVE_MODES:
        raise ValueError(f"invalid mode {mode!r}: use archive_delete or delete_only")
    cut = F.lit(cutoff.isoformat()).cast("date")
    out = None
    for name, (df, day) in tables.items():
        old = F.count_if(day < cut)
        row = df.agg((old if mode == "archive_delete" else F.lit(0)).cast("long").alias("archived_rows"),
                     old.cast("long").alias("deleted_rows"))
        row = row.select(F.lit(name).alias("table_name"), "archived_rows", "deleted_rows")
        out = row if out is None else out.unionByName(row)
    return out


def conform(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Additive schema evolution (A24): add missing columns with their default
    (cast to the declared type) and order columns as the schema says."""
    defaults = defaults or {}
    out = df
    for fld in schema.fields:
        if fld.name not in out.columns:
            out = out.withColumn(fld.name, F.lit(defaults.get(fld.name)).cast(fld.dataType))
    return out.select(*[F.col(fld.name).cast(fld.dataType).alias(fld.name) for fld in schema.fields])


# --------------------------------------------------------------------------- storage

def _partition_path(spark: SparkSession, partition: Sequence[tuple[str, str | None]]) -> str:
    """Relative folder of one partition, spelled as Spark's writer spells it."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(col, value) for col, value in partition)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of the table at ``path``, read off its folder names."""
    cols, here = [], path.rstrip("/")
    while True:
        step = next((n for n in swap.names_in(spark, here) if n.endswith("/") and "=" in n), None)
        if step is None:
            return cols
        cols.append(step.split("=", 1)[0])
        here = f"{here}/{step.rstrip('/')}"


def _values(rows: DataFrame, cols: Sequence[str]) -> list[tuple]:
    """Distinct partition values (with NULLs) of ``rows``: raw values, then their text."""
    pick = rows.select(*cols).distinct()
    return [tuple(r) for r in pick.select(*cols, *[F.col(c).cast("string").alias(f"_text_{c}") for c in cols]).collect()]


def _in_partitions(values: Sequence[tuple], cols: Sequence[str]) -> Column:
    """Literal predicate on partition columns, so that other partitions are not read."""
    if len(cols) == 1:
        some = [v[0] for v in values if v[0] is not None]
        cond = F.col(cols[0]).isin(some) if some else F.lit(False)
        return cond | F.col(cols[0]).isNull() if len(some) < len(values) else cond
    out = F.lit(False)
    for v in values:
        one = F.lit(True)
        for c, x in zip(cols, v):
            one = one & (F.col(c).isNull() if x is None else F.col(c) == F.lit(x))
        out = out | one
    return out


def _replace_partitions(rows: DataFrame, path: str, cols: Sequence[str], affected: Sequence[str],
                        cluster_by: Sequence[str] = ()) -> set[str]:
    """``rows`` take the place of the ``affected`` partition folders.  Returns the folders written."""
    return set(swap.replace(_layout(rows, cols, cluster_by), path, cols, affected))


def _layout(rows: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """File layout of a partitioned write: the ``rebalance`` hint lets AQE
    size the write tasks per partition (a large day is split, small ones are
    combined, no file per shuffle partition and day), and sorting within the
    tasks by ``cluster_by`` gives row groups tight min/max statistics, so a
    look-up by member skips most of a day's row groups."""
    out = rows.hint("rebalance", *partition_by)
    return out.sortWithinPartitions(*partition_by, *cluster_by) if cluster_by else out


def _days(f: dt.date, t: dt.date) -> list[dt.date]:
    return [f + dt.timedelta(days=k) for k in range((t - f).days + 1)]


def write_range_refresh(new: DataFrame, path: str, day_col: str, f: dt.date, t: dt.date,
                        cluster_by: Sequence[str] = ()) -> list[dt.date]:
    """Apply a range refresh to a day-partitioned parquet table at ``path``.

    Returns the days of the range that ended up empty (their partitions were
    removed).  The plan of ``new`` runs once; the list of days is bounded by
    the range length."""
    spark = new.sparkSession
    folder = {d: _partition_path(spark, [(day_col, d.isoformat())]) for d in _days(f, t)}
    staged = _replace_partitions(new.filter(day_between(day_col, f, t)), path, [day_col], list(folder.values()),
                                 cluster_by)
    return [d for d, name in folder.items() if name not in staged]


def write_scoped_refresh(new: DataFrame, path: str, day_col: str, f: dt.date, t: dt.date, scope_col: str,
                         scope_value, key: Sequence[str]) -> None:
    """Apply an agent-scoped refresh: the range days are rebuilt from the old
    rows of those days and the new scoped rows; a table that does not exist
    yet starts with the new scoped rows."""
    old = swap.read_table(new.sparkSession, path, new.schema)
    rebuilt = refresh_scoped_state(old.filter(day_between(day_col, f, t)), new, day_col, f, t, scope_col, scope_value,
                                   key)
    write_range_refresh(rebuilt, path, day_col, f, t, cluster_by=[k for k in key if k != day_col])


def write_full_refresh(new: DataFrame, path: str, partition_by: Sequence[str] = (),
                       cluster_by: Sequence[str] = ()) -> None:
    """Replace the whole content (A19): partitions that ``new`` lacks leave too.
    ``new`` may read the table itself."""
    swap.replace(_layout(new, partition_by, cluster_by) if partition_by else new, path, partition_by)


def write_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``rows`` has rows of; the others stay."""
    swap.replace(rows, path, partition_by, [])


def archive_or_purge(spark: SparkSession, tables: Mapping[str, tuple[str, Column]], cutoff: dt.date,
                     mode: str = "archive_delete", archive_root: str | None = None) -> DataFrame:
    """Archive (optionally) and remove rows before ``cutoff`` from parquet tables.

    ``tables``: name -> (path, day expression).  Archived rows go to
    ``archive_root/<name>/cutoff=<day>``.  The table keeps its partitions:
    those without rows before the cutoff are not touched, one whose rows all
    leave is removed, a mixed one is rewritten; an unpartitioned table is
    rewritten whole.  A table that was never written has nothing to purge.
    The archive batch is complete before any row leaves its table, and both are
    swapped in, so a repeated run (after a failure at any step, or after
    success) ends in the same state: tables with nothing before the cutoff are
    not touched, an archive batch is rewritten whole.  Returns the count rows,
    zeros for what an earlier run has purged."""
    if mode not in ARCHIVE_MODES:
        raise ValueError(f"invalid mode {mode!r}: use archive_delete or delete_only")
    if mode == "archive_delete" and archive_root is None:
        raise ValueError("archive_delete needs archive_root")
    cut = F.lit(cutoff.isoformat()).cast("date")
    frames = {}
    for name, (path, day) in tables.items():
        swap.recover(spark, path)
        if swap.table_exists(spark, path):
            frames[name] = (spark.read.parquet(path), day)
    # One small row per table; it decides below which tables need work.
    counts = archive_purge_counts(frames, cutoff, mode).collect() if frames else []
    todo = {r["table_name"] for r in counts if r["deleted_rows"] > 0}
    for name, (path, day) in tables.items():
        if name not in todo:        # nothing before the cutoff (also a repeated run): leave table and archive
            continue
        df = frames[name][0]
        if mode == "archive_delete":
            # One archive folder per table and cutoff: a run that failed after
            # this step replaces it by the same batch.
            swap.replace(df.filter(day < cut), f"{archive_root.rstrip('/')}/{name}/cutoff={cutoff.isoformat()}")
        cols = partition_columns(spark, path)
        kept = ~F.coalesce(day < cut, F.lit(False))
        if cols:
            values = _values(df.filter(day < cut), cols)
            folders = [_partition_path(spark, list(zip(cols, v[len(cols):]))) for v in values]
            _replace_partitions(df.filter(_in_partitions(values, cols)).filter(kept), path, cols, folders)
        else:
            swap.replace(df.filter(kept), path)
    rows = [tuple(r) for r in counts] + [(name, 0, 0) for name in tables if name not in frames]
    return spark.createDataFrame(rows, "table_name string, archived_rows long, deleted_rows long")


def write_report(report: DataFrame, path: str, day_col: str = "GamingDay", fmt: str = "csv") -> None:
    """Distributed report extract (A25): one folder per gaming day, written by
    the executors (no rows pass through the driver); CSV with a header row or
    parquet.  Overwriting a day's folder makes a re-run idempotent."""
    w = _layout(report, [day_col], ()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(day_col)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_upsert(batch: DataFrame, path: str, key: Sequence[str], seq: Column,
                 partition_by: Sequence[str] = ()) -> None:
    """Keyed last-wins upsert of ``batch`` into the parquet table at ``path``.

    A part of the key is a column or a SQL expression over the columns (A8).
    With ``partition_by`` the affected partitions are read and rewritten: those
    of the batch's rows and, unless the partition columns belong to the key,
    those that now hold rows of the batch's keys (found from the table's key
    columns alone), so a row whose partition changes leaves the old one.
    Without partitions the whole table is swapped.  NULL partitions and NULL
    keys are values like others.  Repeating the same batch gives the same
    table."""
    from ..operators.dedupe import key_columns, upsert_last_wins
    spark = batch.sparkSession
    cols = list(partition_by)
    target = swap.read_table(spark, path, batch.schema)
    batch = batch.select(*target.columns)
    if cols:
        values = set(_values(batch, cols))
        if not set(cols) <= set(key):
            keys = batch.select(*[k.alias(f"_key_{i}") for i, k in enumerate(key_columns(batch, key))]).distinct()
            same = F.lit(True)
            for i, k in enumerate(key_columns(target, key)):
                same = same & k.eqNullSafe(F.col(f"_key_{i}"))
            values |= set(_values(target.join(keys, same, "left_semi"), cols))
        if not values and swap.table_exists(spark, path):
            return
        state = upsert_last_wins(target.filter(_in_partitions(sorted(values, key=str), cols)), batch, list(key), seq)
        folders = [_partition_path(spark, list(zip(cols, v[len(cols):]))) for v in values]
        _replace_partitions(state, path, cols, folders, [k for k in key if k in target.columns and k not in cols])
    else:
        swap.replace(upsert_last_wins(target, batch, list(key), seq), path)
