"""Detail tables that carry their parent's day.

Table sessions, their details, the details' chips and the money rows of an
operation have no day of their own: a one-day run would read and shuffle their
whole history to find one day's rows.  Here the day is carried down when the
rows are loaded: each child row is stored in the partition ``carried_day`` of
its parent's day, along the chain tracking -> session -> detail -> chip and
from operation to its money rows.  The plans filter on ``carried_day`` where a
table has it, so a run reads and joins the days it works on, nothing else.

A load takes the new rows of any of the tables.  Children of a parent that
arrives later, or whose day changes, are found by the parent ids of the batch
(from the stored id columns) and move to their new partition.  Rows without a
known parent wait in the NULL partition.  Repeating a load changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import day_between
from . import sinks, swap

CARRIED = "carried_day"


@dataclass(frozen=True)
class Link:
    """A child table, its key, the column that names its parent, and the parent's day."""
    table: str
    key: tuple[str, ...]
    up: str
    parent: str
    parent_day: str = CARRIED
    own_day: str | None = None      # SQL expression for rows whose parent has no day


LINKS = (
    Link("player_sessions", ("idplayerstracking", "timestart"), "idplayerstracking", "players_tracking", "datework",
         "to_date(timestart)"),
    Link("session_details", ("idplayersessiondetail",), "idplayersession", "player_sessions"),
    Link("session_detail_chips", ("idplayersessiondetail", "idchip"), "idplayersessiondetail", "session_details"),
    Link("tx_money", ("idoper", "idmoney"), "idoper", "cashdesk_tx", "datework"),
    Link("tx_calculated", ("idoper",), "idoper", "cashdesk_tx", "datework"),
)


def of_days(df: DataFrame, f, t) -> DataFrame:
    """The rows of the day range, if the table carries its day; else all rows."""
    return df.filter(day_between(CARRIED, f, t)).drop(CARRIED) if CARRIED in df.columns else df


def parent_days(parents: DataFrame, link: Link) -> DataFrame:
    """(parent id, day), one row per id; an id with two days cannot be placed and raises."""
    days = parents.filter(F.col(link.up).isNotNull()).groupBy(F.col(link.up).alias("_up")).agg(
        F.min(link.parent_day).alias("_day"), F.max(link.parent_day).alias("_other"))
    twice = F.raise_error(F.concat(F.lit(f"{link.parent}.{link.up} has two days: "), F.col("_up").cast("string")))
    return days.select("_up", F.when(F.col("_day") < F.col("_other"), twice.cast("date")).otherwise(F.col("_day"))
                       .alias("_day"))


def with_day(rows: DataFrame, parents: DataFrame, link: Link) -> DataFrame:
    """``rows`` with the day of their parent (or their own, or NULL)."""
    own = F.expr(link.own_day) if link.own_day else F.lit(None).cast("date")
    joined = rows.join(parent_days(parents, link), F.col(link.up) == F.col("_up"), "left")
    return joined.withColumn(CARRIED, F.coalesce(F.col("_day"), own)).drop("_up", "_day")


def _misplaced(stored: DataFrame, changed: DataFrame, parents: DataFrame, link: Link) -> DataFrame:
    """Stored children of the changed parents that stand in another day's partition."""
    ids = changed.select(F.col(link.up).alias("_changed")).distinct()
    rows = stored.join(ids, F.col(link.up) == F.col("_changed"), "left_semi").withColumnRenamed(CARRIED, "_was")
    return with_day(rows, parents, link).filter(~F.col(CARRIED).eqNullSafe(F.col("_was"))).drop("_was")


def load_with_days(spark: SparkSession, batches: Mapping[str, DataFrame], parents: Mapping[str, DataFrame],
                   tables: Mapping[str, str]) -> None:
    """Load new rows of the detail tables into their day partitions.

    ``batches``: the run's new or changed rows by table, parents included;
    ``parents``: the whole day-bearing tables at the head of the chains
    (``players_tracking``, ``cashdesk_tx``); ``tables``: stored paths of the
    children.  Later rows of a key win."""
    written = dict(batches)
    with ExitStack() as stack:
        for link in LINKS:
            if link.table not in tables or not {link.table, link.parent} & set(written):
                continue
            path = tables[link.table]
            above = parents[link.parent] if link.parent in parents else swap.read_table(
                spark, tables[link.parent], T.StructType([T.StructField(link.up, T.LongType()),
                                                          T.StructField(CARRIED, T.DateType())]))
            rows = None
            if link.table in batches:
                rows = with_day(batches[link.table], above, link)
            if link.parent in written and swap.table_exists(spark, path):
                moved = _misplaced(swap.read_table(spark, path), written[link.parent], above, link)
                if rows is not None:
                    again = rows.select(*[F.col(k).alias(f"_again_{k}") for k in link.key])
                    same = F.lit(True)
                    for k in link.key:
                        same = same & F.col(k).eqNullSafe(F.col(f"_again_{k}"))
                    moved = rows.unionByName(moved.join(again, same, "left_anti"))
                rows = moved
            if rows is not None:
                # read from the table it is about to change: cut loose first
                written[link.table] = rows = stack.enter_context(swap.held(rows))
                sinks.write_upsert(rows, path, list(link.key), F.lit(0), [CARRIED])


class DayTables:
    """Bronze accessor that takes the stored, day-carrying tables where there are any."""

    def __init__(self, spark: SparkSession, bronze, tables: Mapping[str, str]):
        self.spark, self._bronze, self._tables = spark, bronze, tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            return getattr(self._bronze, name)
        rows = swap.read_table(self.spark, self._tables[name])
        # a table without any partition has the day as a plain column
        if not isinstance(rows.schema[CARRIED].dataType, T.DateType):
            rows = rows.withColumn(CARRIED, F.col(CARRIED).cast("date"))
        self.__dict__[name] = rows
        return rows
