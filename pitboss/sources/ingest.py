"""Incremental extract: high-water marks, sliding re-read, keyed upsert, control rows.

A source is described by a ``SourceConfig``; the extract is a filtered,
column-pruned scan, so the watermark predicate reaches the parquet reader
(``PushedFilters``) and only new row groups are read.  The watermark itself
is the only driver-side state: one scalar per source, kept in a small control
table (``watermark_state``) that is itself maintained with the keyed upsert.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import latest_per_key, upsert_last_wins
from . import swap

WM_TYPES = {"int": "long", "datetime": "timestamp_ntz", "text": "string"}
DEFAULT_LOOKBACK_DAYS = 3   # fixed value: default sliding re-read window


@dataclass(frozen=True)
class SourceConfig:
    """One source: columns to read, watermark, optional re-read window, upsert key."""
    name: str
    columns: tuple[str, ...]
    watermark_column: str | None = None
    watermark_type: str = "text"
    key: tuple[str, ...] = ()              # column names or SQL expressions; NULL keys match each other
    lookback_column: str | None = None
    lookback_days: int | None = None
    full_snapshot: bool = False
    member_column: str | None = None
    bool_columns: tuple[str, ...] = field(default=())
    # "strict": rows beyond the watermark.  "inclusive": also those that share it,
    # so that rows which arrive later with the last instant are not missed; rows
    # of a keyed source are upserted again, appended ones only if not yet stored.
    border: str = "strict"


def typed_watermark(raw: str | None, wm_type: str) -> Column:
    """Stored text watermark as a typed literal (A11); NULL stays NULL."""
    return F.lit(raw).cast("string").cast(WM_TYPES[wm_type])


def project(df: DataFrame, cfg: SourceConfig) -> DataFrame:
    """Column-pruned read of a configured source (A1) with bool coercion (A10)."""
    out = df.select(*cfg.columns)
    for c in cfg.bool_columns:
        out = out.withColumn(c, coerce_bool(c))
    return out


def coerce_bool(c: Column | str) -> Column:
    """Nullable 0/1 integer -> nullable boolean (A10)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("boolean")


def watermark_filter(cfg: SourceConfig, watermark: str | None, today: dt.date | None = None) -> Column:
    """Extract predicate: ``wm IS NULL OR col > wm`` (A3), or with a re-read
    window ``... OR lookback_col >= today - N`` (A4).  The source-side member
    filter (A5) is added when configured."""
    wm = typed_watermark(watermark, cfg.watermark_type)
    beyond = F.col(cfg.watermark_column) >= wm if cfg.border == "inclusive" else F.col(cfg.watermark_column) > wm
    cond = wm.isNull() | beyond
    if cfg.lookback_column is not None:
        if today is None:
            raise ValueError("a re-read window needs the run day")
        days = cfg.lookback_days if cfg.lookback_days is not None else DEFAULT_LOOKBACK_DAYS
        start = F.lit((today - dt.timedelta(days=days)).isoformat()).cast("date")
        cond = cond | (F.to_date(F.col(cfg.lookback_column)) >= start)
    if cfg.member_column is not None:
        cond = cond & F.col(cfg.member_column).isNotNull()
    return cond


def extract(df: DataFrame, cfg: SourceConfig, watermark: str | None, today: dt.date | None = None) -> DataFrame:
    """Rows to load in this run: everything for a full snapshot (A2), else the
    watermark (and re-read) filter."""
    src = project(df, cfg)
    if cfg.full_snapshot:
        return src
    return src.filter(watermark_filter(cfg, watermark, today))


def advance_watermark(extracted: DataFrame, cfg: SourceConfig, old: str | None,
                      run_at: dt.datetime | None = None) -> DataFrame:
    """New control row (A6): ``max`` over the extract, never below the old value
    and unchanged on an empty extract; a snapshot stores the run time.  One
    aggregate row -- the watermark never leaves Spark as a collected list."""
    if cfg.full_snapshot:
        value = F.lit((run_at or dt.datetime(1970, 1, 1)).isoformat())
        return extracted.sparkSession.range(1).select(
            F.lit(cfg.name).alias("source_table"), F.lit(cfg.watermark_column).alias("watermark_column"),
            value.alias("watermark_value"))
    old_typed = typed_watermark(old, cfg.watermark_type)
    agg = extracted.agg(F.max(cfg.watermark_column).alias("_mx"))
    new = F.when(F.col("_mx").isNull(), old_typed).when(old_typed.isNull(), F.col("_mx")) \
        .otherwise(F.greatest(F.col("_mx"), old_typed))
    return agg.select(F.lit(cfg.name).alias("source_table"), F.lit(cfg.watermark_column).alias("watermark_column"),
                      _wm_text(new, cfg.watermark_type).alias("watermark_value"))


def _wm_text(c: Column, wm_type: str) -> Column:
    if wm_type == "datetime":
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return c.cast("string")


def upsert_watermark(state: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Control table after setting watermarks (A12): keyed on the source name."""
    return upsert_last_wins(state, new_rows, ["source_table"], F.lit(0))


def seed_if_absent(target: DataFrame, seeds: DataFrame, key: Sequence[str]) -> DataFrame:
    """Insert seed rows whose key is absent; existing rows stay as they are (A12 seeds)."""
    return target.unionByName(seeds.join(target.select(*key), list(key), "left_anti"))


def run_log_rows(spark: SparkSession, pipeline: str, counts: DataFrame) -> DataFrame:
    """Run-log rows (A13) from per-source counts ``(source_table, rows_read,
    rows_written)``; with an ``error_message`` column, rows that have one failed."""
    error = F.col("error_message") if "error_message" in counts.columns else F.lit(None)
    return counts.select(F.lit(pipeline).alias("pipeline_name"), "source_table",
                         F.when(error.isNull(), "success").otherwise("failed").alias("status"),
                         F.col("rows_read").cast("long").alias("rows_read"),
                         F.col("rows_written").cast("long").alias("rows_written"),
                         error.cast("string").alias("error_message"))


def load(target: DataFrame, extracted: DataFrame, cfg: SourceConfig, seq: Column) -> DataFrame:
    """Target state after one run: keyed upsert (A7), or append when the source
    has no key (A9, visits)."""
    if not cfg.key:
        return target.unionByName(extracted)
    return upsert_last_wins(target, extracted, list(cfg.key), seq)


def dedupe_batch(extracted: DataFrame, key: Sequence[str | Column], seq: Column) -> DataFrame:
    """Last-wins reduction of one batch on its key (expression keys allowed, A8)."""
    return latest_per_key(extracted, key, [seq])


def read_watermark(spark: SparkSession, control_path: str, source: str) -> str | None:
    """The stored text watermark of one source (one scalar reaches the driver)."""
    swap.recover(spark, control_path)
    if not swap.table_exists(spark, control_path):
        return None
    rows = (spark.read.parquet(control_path).filter(F.col("source_table") == source)
            .select("watermark_value").limit(1).collect())
    return rows[0][0] if rows else None


def not_yet_stored(extracted: DataFrame, stored: DataFrame, cfg: SourceConfig, watermark: str | None) -> DataFrame:
    """The extract without the rows that an append-only table already has of the
    border instant (as often as it has them)."""
    if watermark is None:
        return extracted
    at_border = F.col(cfg.watermark_column) == typed_watermark(watermark, cfg.watermark_type)
    have = stored.select(*extracted.columns).filter(at_border)
    return extracted.filter(~at_border).unionByName(extracted.filter(at_border).exceptAll(have))


def log_run(spark: SparkSession, log_path: str, source: str, run_at: dt.datetime, rows_read: int = 0,
            rows_written: int = 0, error: str | None = None) -> DataFrame:
    """Append one run-log row (A13), and return it."""
    counts = spark.range(1).select(F.lit(source).alias("source_table"), F.lit(rows_read).alias("rows_read"),
                                   F.lit(rows_written).alias("rows_written"),
                                   F.lit(error[:2000] if error else None).cast("string").alias("error_message"))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    log = (run_log_rows(spark, "bronze_incremental", counts)
           .withColumn("started_at_utc", F.lit(run_at.isoformat(sep=" ")).cast("timestamp"))
           .withColumn("finished_at_utc", F.lit(now.isoformat(sep=" ")).cast("timestamp")))
    log.write.mode("append").parquet(log_path)
    return log


def run_incremental(spark: SparkSession, source: DataFrame, cfg: SourceConfig, target_path: str, control_path: str,
                    log_path: str, seq: Column, run_at: dt.datetime, today: dt.date | None = None,
                    partition_by: Sequence[str] = ()) -> DataFrame:
    """One incremental load of one source (A1-A13 as a job).

    Reads the watermark, extracts (watermark / re-read / full snapshot), loads
    the target (keyed upsert, or append for a source without key), advances
    the watermark in the control table and appends a run-log row, which is
    also returned.  The extract is written once to the shared checkpoint folder
    for the time of the run, so the target write, the new watermark and the
    counts all see the same snapshot of the source and the source is read once.

    A run that fails before the watermark moves is repeated from the same
    watermark.  The keyed upsert makes that harmless; appended rows go to a
    partition ``loaded_from`` named after the watermark the run started from,
    which a repeat overwrites.  A failure is logged and raised."""
    from .sinks import write_partitions, write_upsert
    run_ts = F.lit(run_at.isoformat(sep=" ")).cast("timestamp")
    rows_read = 0

    def logged(written: int, error: str | None) -> DataFrame:
        return log_run(spark, log_path, cfg.name, run_at, rows_read, written, error)

    try:
        old = read_watermark(spark, control_path, cfg.name)
        # never a bare number or time: the folder's name must read back as text
        loaded_from = "start" if old is None else f"after {old}"
        extracted = extract(source, cfg, old, today)
        swap.recover(spark, target_path)
        if cfg.border == "inclusive" and not cfg.key and swap.table_exists(spark, target_path):
            # what a failed run appended from this watermark is written again as a whole
            stored = spark.read.parquet(target_path).filter(F.col("loaded_from") != F.lit(loaded_from))
            extracted = not_yet_stored(extracted, stored, cfg, old)
        with swap.held(extracted) as batch:
            rows_read = batch.count()
            if rows_read:
                if cfg.key:
                    write_upsert(batch, target_path, list(cfg.key), seq, partition_by)
                else:
                    write_partitions(batch.withColumn("loaded_from", F.lit(loaded_from)),
                                     target_path, ["loaded_from", *partition_by])
                wm = advance_watermark(batch, cfg, old, run_at).withColumn("updated_at_utc", run_ts)
                write_upsert(wm, control_path, ["source_table"], F.col("updated_at_utc"))
    except Exception as e:
        logged(0, f"{type(e).__name__}: {e}")
        raise
    return logged(rows_read, None)


def run_sources(spark: SparkSession, jobs: Sequence[dict]) -> dict[str, str | None]:
    """Load several sources one after another; each job holds the arguments of
    ``run_incremental``.  A source that fails is logged and the next one goes
    on; returns each source's error, None for success."""
    errors: dict[str, str | None] = {}
    for job in jobs:
        try:
            run_incremental(spark, **job)
            errors[job["cfg"].name] = None
        except Exception as e:  # logged by run_incremental; the caller sees it in the result
            errors[job["cfg"].name] = f"{type(e).__name__}: {e}"
    return errors
