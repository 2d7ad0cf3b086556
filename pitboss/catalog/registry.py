"""Named queries: a Spark builder and (optionally) an independent SQL form.

``register`` records ``name -> (builder(spark, sf_dir) -> DataFrame, sql)``.
The SQL is written from the warehouse's semantics, not from the Spark
formulation (e.g. the clean drop is a recursive pool walk there, the as-of
look-up a correlated ORDER BY/LIMIT 1), so agreement is meaningful.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..sources import swap


def scratch(spark: SparkSession) -> str:
    """A new folder on shared storage, deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    fs, p = swap.fs_path(spark, path)
    fs.deleteOnExit(p)
    return path


Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    builder: Builder
    sql: str | None
    survey_ids: str


ENTRIES: dict[str, Entry] = {}


def register(name: str, survey_ids: str = "", sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in ENTRIES:
            raise ValueError(f"duplicate entry {name}")
        ENTRIES[name] = Entry(name, fn, sql, survey_ids)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    """Import every module that registers entries."""
    from . import (entries_silver, entries_gold, entries_ingest, entries_positions,  # noqa: F401
                   entries_stored)  # noqa: F401
    return ENTRIES
