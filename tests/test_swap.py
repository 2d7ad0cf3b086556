"""Writers that die at every single step, and tables without rows."""

import datetime as dt
import itertools
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from pitboss.plans import loads, quality
from pitboss.sources import sinks, swap

D = [dt.date(2024, 1, d) for d in range(1, 8)]
SCH = "gamingday date, membership long, idagent long, v long"
COLS = ("gamingday", "membership", "idagent", "v")
OLD = [(D[0], 1, 6, 1), (D[0], 2, 7, 1), (D[1], 3, 6, 1), (D[2], 4, 6, 1), (None, 5, 6, 1)]
STEPS = ("move", "delete_path", "write_text")


class Died(Exception):
    pass


def _root():
    return tempfile.mkdtemp(prefix="pitboss-test-")


def _state(spark, path):
    return sorted((tuple(r[c] for c in COLS) for r in spark.read.parquet(path).collect()), key=str)


def _upsert(spark, path):
    batch = spark.createDataFrame([(D[3], 1, 6, 2), (D[1], 3, 6, 2), (None, 9, 6, 2)], SCH)
    sinks.write_upsert(batch, path, ["membership"], F.col("v"), ["gamingday"] if "days" in path else [])


def _range(spark, path):
    sinks.write_range_refresh(spark.createDataFrame([(D[1], 3, 6, 2)], SCH), path, "gamingday", D[0], D[1])


def _scoped(spark, path):
    new = spark.createDataFrame([(D[0], 2, 6, 2), (D[1], 8, 6, 2), (D[1], 9, 7, 2)], SCH)
    sinks.write_scoped_refresh(new, path, "gamingday", D[0], D[1], "idagent", 6, ["gamingday", "membership"])


def _full(spark, path):
    sinks.write_full_refresh(spark.createDataFrame([(D[1], 3, 6, 2), (D[4], 1, 6, 2)], SCH), path,
                             ["gamingday"] if "days" in path else [])


def _purge(spark, path):
    sinks.archive_or_purge(spark, {"t": (path, F.col("gamingday"))}, D[1], "archive_delete", path + "-archive")


AFTER_UPSERT = [(D[0], 2, 7, 1), (D[1], 3, 6, 2), (D[2], 4, 6, 1), (D[3], 1, 6, 2), (None, 5, 6, 1), (None, 9, 6, 2)]
WRITERS = {
    "upsert, days": (_upsert, AFTER_UPSERT),
    "upsert, one folder": (_upsert, AFTER_UPSERT),
    "range, days": (_range, [(D[1], 3, 6, 2), (D[2], 4, 6, 1), (None, 5, 6, 1)]),
    "scoped, days": (_scoped, [(D[0], 2, 6, 2), (D[1], 8, 6, 2), (D[2], 4, 6, 1), (None, 5, 6, 1)]),
    "full, days": (_full, [(D[1], 3, 6, 2), (D[4], 1, 6, 2)]),
    "full, one folder": (_full, [(D[1], 3, 6, 2), (D[4], 1, 6, 2)]),
    "purge, days": (_purge, OLD[2:]),
    "purge, one folder": (_purge, OLD[2:]),
}


@pytest.fixture
def few_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", WRITERS)
def test_dies_at_every_step_and_is_repeated(spark, few_tasks, name):
    """Before each file operation: the repeated run ends in the right state."""
    run, want = WRITERS[name]
    root = _root()
    kind = "days" if "days" in name else "flat"
    w = spark.createDataFrame(OLD, SCH).coalesce(1).write
    (w.partitionBy("gamingday") if kind == "days" else w).parquet(f"{root}/{kind}-start")
    for k in itertools.count():
        path, done = f"{root}/{kind}-{k}", 0
        shutil.copytree(f"{root}/{kind}-start", path)
        with pytest.MonkeyPatch.context() as m:
            for step in STEPS:
                def dying(*args, _real=getattr(swap, step)):
                    nonlocal done
                    done += 1
                    if done == k + 1:
                        raise Died
                    _real(*args)
                m.setattr(swap, step, dying)
            try:
                run(spark, path)
            except Died:
                pass
        finished = done <= k
        if not finished:
            run(spark, path)
        assert _state(spark, path) == sorted(want, key=str), k
        assert not os.path.isdir(f"{path}/{swap.CONTROL}") or os.listdir(f"{path}/{swap.CONTROL}") == []
        if name.startswith("purge"):
            assert _state(spark, f"{path}-archive/t/cutoff=2024-01-02") == sorted(OLD[:2], key=str)
        if finished:
            assert k >= 3
            return


def test_dies_while_staging(spark):
    path = f"{_root()}/t"
    spark.createDataFrame(OLD, SCH).write.partitionBy("gamingday").parquet(path)
    bad = spark.createDataFrame([(D[0], 1, 6, 1)], SCH).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_full_refresh(bad, path, ["gamingday"])
    assert _state(spark, path) == sorted(OLD, key=str)
    _range(spark, path)
    assert os.listdir(f"{path}/{swap.CONTROL}") == []


def test_committed_swap_is_finished_by_the_next_writer(spark, monkeypatch):
    """Two different writers: the first one's change is made, then the second one's."""
    path = f"{_root()}/days"
    spark.createDataFrame(OLD, SCH).write.partitionBy("gamingday").parquet(path)
    with monkeypatch.context() as m:
        m.setattr(swap, "_finish", lambda *a: (_ for _ in ()).throw(Died))
        with pytest.raises(Died):
            _range(spark, path)
    assert _state(spark, path) == sorted(OLD, key=str)
    _upsert(spark, path)
    assert _state(spark, path) == sorted([(D[1], 3, 6, 2), (D[2], 4, 6, 1), (None, 5, 6, 1), (D[3], 1, 6, 2),
                                          (None, 9, 6, 2)], key=str)


# --------------------------------------------------------------------------- empty tables

NONE = "gamingday > '9999-01-01'"


def test_emptied_table_reads_as_zero_rows(spark):
    path = f"{_root()}/t"
    rows = spark.createDataFrame(OLD[:3], SCH)
    sinks.write_range_refresh(rows, path, "gamingday", D[0], D[1])
    assert sinks.write_range_refresh(rows.where(NONE), path, "gamingday", D[0], D[1]) == [D[0], D[1]]
    for read in (spark.read.parquet, lambda p: swap.read_table(spark, p)):
        assert read(path).count() == 0 and sorted(read(path).columns) == sorted(COLS)
        assert read(path).schema["gamingday"].dataType.simpleString() == "date"
    window = quality.refresh_window(swap.read_table(spark, path), "gamingday", D[4]).first()
    assert (window["from_day"], window["to_day"], window["mode"]) == (D[4], D[4], "daily")
    assert not quality.health_check(swap.read_table(spark, path), "gamingday", D[4]).first()["has_rows"]
    _scoped(spark, path)  # and is filled again
    assert _state(spark, path) == [(D[0], 2, 6, 2), (D[1], 8, 6, 2)]


@pytest.mark.parametrize("write", [
    lambda e, p: sinks.write_range_refresh(e, p, "gamingday", D[0], D[1]),
    lambda e, p: sinks.write_scoped_refresh(e, p, "gamingday", D[0], D[1], "idagent", 6, ["gamingday", "membership"]),
    lambda e, p: sinks.write_full_refresh(e, p, ["gamingday"]),
    lambda e, p: sinks.write_full_refresh(e, p),
    lambda e, p: sinks.write_upsert(e, p, ["membership"], F.col("v")),
    lambda e, p: sinks.write_upsert(e, p, ["membership"], F.col("v"), ["gamingday"]),
])
def test_first_run_without_rows(spark, write):
    path = f"{_root()}/t"
    for _ in range(2):
        write(spark.createDataFrame([], SCH), path)
        assert spark.read.parquet(path).count() == 0 and set(spark.read.parquet(path).columns) == set(COLS)
    write(spark.createDataFrame(OLD[:3], SCH), path)
    scoped = "write_scoped_refresh" in write.__code__.co_names
    assert _state(spark, path) == sorted([r for r in OLD[:3] if r[2] == 6 or not scoped], key=str)


def test_purge_of_everything_is_repeatable(spark):
    root = _root()
    tables = {"t": (f"{root}/t", F.col("gamingday")), "flat": (f"{root}/flat", F.col("gamingday")),
              "never": (f"{root}/never", F.col("gamingday"))}
    spark.createDataFrame(OLD[:4], SCH).write.partitionBy("gamingday").parquet(f"{root}/t")
    spark.createDataFrame(OLD[:4], SCH).write.parquet(f"{root}/flat")
    counts = []
    for _ in range(3):
        out = sinks.archive_or_purge(spark, tables, D[6], "archive_delete", f"{root}/archive").collect()
        counts.append({r["table_name"]: (r["archived_rows"], r["deleted_rows"]) for r in out})
        for name in ("t", "flat"):
            assert spark.read.parquet(f"{root}/{name}").count() == 0
            assert _state(spark, f"{root}/archive/{name}/cutoff=2024-01-07") == sorted(OLD[:4], key=str)
    assert counts == [{"t": (4, 4), "flat": (4, 4), "never": (0, 0)}] + [dict.fromkeys(tables, (0, 0))] * 2


def test_never_filled_table(spark):
    path = f"{_root()}/t"
    assert not swap.table_exists(spark, path)
    schema = spark.createDataFrame([], SCH).schema
    assert swap.read_table(spark, path, schema).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        swap.read_table(spark, path)


def test_partitioned_full_refresh_keeps_no_old_day(spark):
    path = f"{_root()}/days"
    spark.createDataFrame(OLD, SCH).write.partitionBy("gamingday", "idagent").parquet(path)
    rows = spark.read.parquet(path).where("gamingday >= '2024-01-02'")
    sinks.write_full_refresh(rows, path, ["gamingday", "idagent"])  # reads the table it replaces
    assert _state(spark, path) == sorted([OLD[2], OLD[3]], key=str)
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["gamingday=2024-01-02", "gamingday=2024-01-03"]


def test_columns_added_later(spark):
    """A new column reaches the stored schema; earlier rows have NULL there."""
    path = f"{_root()}/days"
    sinks.write_full_refresh(spark.createDataFrame(OLD, SCH), path, ["gamingday"])
    wider = spark.createDataFrame([(D[0], 1, 6, 5, "new")], SCH + ", note string")
    sinks.write_range_refresh(wider, path, "gamingday", D[0], D[0])
    got = {(r["membership"], r["note"]) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "new"), (3, None), (4, None), (5, None)}
    sinks.write_range_refresh(spark.createDataFrame(OLD[2:3], SCH), path, "gamingday", D[1], D[1])
    assert "note" in spark.read.parquet(path).columns
    sinks.write_full_refresh(spark.createDataFrame(OLD, SCH), path, ["gamingday"])
    assert "note" not in spark.read.parquet(path).columns


def test_first_day_without_sessions(spark, bronze):
    """The marts of a range without sessions are empty tables, and the daily run goes on."""
    root = _root()
    tables = {n: os.path.join(root, n) for n in ("fact_player_session", "fact_session_day_by_table_game",
                                                  "fact_session_day_by_agent_group")}
    for _ in range(2):
        loads.load_session_marts(bronze, dt.date(1999, 1, 1), dt.date(1999, 1, 2), tables)
        assert all(spark.read.parquet(p).count() == 0 for p in tables.values())
