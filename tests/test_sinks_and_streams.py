"""Storage-side maintenance: range refresh empties days, scoped refresh keeps keys
unique, refresh is idempotent, archive/purge counts, streaming upsert."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pitboss.sources import sinks
from pitboss.streaming.incremental import incremental_upsert

SCH = "gamingday date, membership long, idagent int, amount int"
D = [dt.date(2024, 1, d) for d in range(1, 5)]


def _tmp():
    return tempfile.mkdtemp(prefix="pitboss-test-")


def _read(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("gamingday", "membership", "idagent", "amount").collect())


def test_range_refresh_empties_missing_day(spark):
    path = os.path.join(_tmp(), "fact")
    old = spark.createDataFrame([(d, 1, 7, 1) for d in D], SCH)
    old.write.partitionBy("gamingday").parquet(path)
    new = spark.createDataFrame([(D[1], 1, 7, 2)], SCH)          # day 3 now has no rows
    emptied = sinks.write_range_refresh(new, path, "gamingday", D[1], D[2])
    assert emptied == [D[2]]
    assert _read(spark, path) == [(D[0], 1, 7, 1), (D[1], 1, 7, 2), (D[3], 1, 7, 1)]
    # twice = once
    sinks.write_range_refresh(new, path, "gamingday", D[1], D[2])
    assert _read(spark, path) == [(D[0], 1, 7, 1), (D[1], 1, 7, 2), (D[3], 1, 7, 1)]


def test_scoped_refresh_agent_change_keeps_key_unique(spark):
    path = os.path.join(_tmp(), "fact")
    old = spark.createDataFrame([(D[0], 1, 5, 1), (D[0], 2, 6, 1)], SCH)   # member 1 had agent 5
    old.write.partitionBy("gamingday").parquet(path)
    new = spark.createDataFrame([(D[0], 1, 6, 9), (D[0], 2, 6, 3)], SCH)   # now agent 6
    sinks.write_scoped_refresh(new, path, "gamingday", D[0], D[0], "idagent", 6, ["gamingday", "membership"])
    rows = _read(spark, path)
    assert rows == [(D[0], 1, 6, 9), (D[0], 2, 6, 3)]


def test_archive_or_purge(spark):
    root = _tmp()
    path, arch = os.path.join(root, "visits"), os.path.join(root, "archive")
    df = spark.createDataFrame([(D[0], 1, 1, 1), (D[1], 1, 1, 1), (D[3], 1, 1, 1), (None, 1, 1, 1)], SCH)
    df.write.parquet(path)
    counts = sinks.archive_or_purge(spark, {"v": (path, F.col("gamingday"))}, D[2], "archive_delete", arch).collect()
    assert [(r["table_name"], r["archived_rows"], r["deleted_rows"]) for r in counts] == [("v", 2, 2)]
    assert spark.read.parquet(path).count() == 2          # day 4 and the NULL day stay
    assert spark.read.parquet(os.path.join(arch, "v")).count() == 2
    # a repeated run after success changes nothing (the archive batch is kept)
    again = sinks.archive_or_purge(spark, {"v": (path, F.col("gamingday"))}, D[2], "archive_delete", arch).collect()
    assert again[0]["deleted_rows"] == 0
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(os.path.join(arch, "v")).count() == 2
    # a run repeated after failing between archive and rewrite archives nothing twice
    df.write.mode("overwrite").parquet(path)
    sinks.archive_or_purge(spark, {"v": (path, F.col("gamingday"))}, D[2], "archive_delete", arch)
    assert spark.read.parquet(os.path.join(arch, "v")).count() == 2
    with pytest.raises(ValueError):
        sinks.archive_or_purge(spark, {"v": (path, F.col("gamingday"))}, D[2], "drop_all")


def test_streaming_upsert_available_now(spark):
    root = _tmp()
    land, target = os.path.join(root, "landing"), os.path.join(root, "target")
    schema = "k long, seq long, val string, day date"
    spark.createDataFrame([(1, 1, "a", D[0]), (2, 1, "b", D[0])], schema).write.mode("append").parquet(land)
    sch = spark.read.parquet(land).schema
    q = incremental_upsert(spark, land, sch, target, ["k"], "seq", os.path.join(root, "ckpt"), partition_by=["day"])
    q.awaitTermination()
    spark.createDataFrame([(1, 2, "a2", D[0]), (3, 1, "c", D[1])], schema).write.mode("append").parquet(land)
    q = incremental_upsert(spark, land, sch, target, ["k"], "seq", os.path.join(root, "ckpt"), partition_by=["day"])
    q.awaitTermination()
    got = {r["k"]: r["val"] for r in spark.read.parquet(target).collect()}
    assert got == {1: "a2", 2: "b", 3: "c"}


def test_write_report_per_day(spark, bronze):
    from pitboss.plans import gold
    from pitboss.sources.adapters import FROM_DAY, TO_DAY
    out = os.path.join(_tmp(), "report")
    rep = gold.visit_report_extract(gold.visit_sessions(bronze, FROM_DAY, TO_DAY))
    sinks.write_report(rep, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == rep.count()
    assert back.select("GamingDay").distinct().count() == rep.select("GamingDay").distinct().count()


def test_run_incremental_twice(spark):
    import datetime as dtm
    from pitboss.sources import ingest
    root = _tmp()
    target, control, log = (os.path.join(root, n) for n in ("target", "control", "log"))
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts", "user_id", "value")
    cfg = ingest.SourceConfig("events", ("event_id", "ts", "user_id", "value"), "event_id", "int",
                              key=("event_id",), member_column="user_id")
    first = ev.filter(F.col("event_id") <= 5000)
    r1 = ingest.run_incremental(spark, first, cfg, target, control, log, F.col("event_id"), dtm.datetime(2024, 2, 1))
    assert r1.collect()[0]["rows_read"] == first.count()
    assert ingest.read_watermark(spark, control, "events") == str(first.agg(F.max("event_id")).collect()[0][0])
    r2 = ingest.run_incremental(spark, ev, cfg, target, control, log, F.col("event_id"), dtm.datetime(2024, 2, 2))
    assert r2.collect()[0]["rows_read"] == ev.count() - first.count()      # only rows past the watermark
    assert spark.read.parquet(target).count() == ev.count()
    r3 = ingest.run_incremental(spark, ev, cfg, target, control, log, F.col("event_id"), dtm.datetime(2024, 2, 3))
    assert r3.collect()[0]["rows_read"] == 0                                # caught up: nothing re-read
    assert spark.read.parquet(log).count() == 3
    assert spark.read.parquet(control).count() == 1


def test_load_membership_day_range_and_agent_scope(spark, bronze):
    from pitboss.operators.keys import assert_key
    from pitboss.plans import loads, silver
    f, t = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    path = os.path.join(_tmp(), "fact_membership_day")
    loads.load_membership_day(bronze, f, t, path)
    stored = spark.read.parquet(path)
    assert stored.count() == silver.membership_day(bronze, f, t).count()
    loads.load_membership_day(bronze, f, t, path, agent_id=3)      # scoped re-load: same state
    stored = spark.read.parquet(path)
    assert_key(stored, ["gamingday", "membership"])
    assert stored.count() == silver.membership_day(bronze, f, t).count()


def test_load_session_marts(spark, bronze):
    from pitboss.plans import gold, loads
    f, t = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    root = _tmp()
    tables = {n: os.path.join(root, n) for n in ("fact_player_session", "fact_session_day_by_table_game",
                                                  "fact_session_day_by_agent_group")}
    loads.load_session_marts(bronze, f, t, tables)
    got = spark.read.parquet(tables["fact_session_day_by_table_game"])
    want = gold.mart_table_game(bronze, f, t)
    cols = sorted(want.columns)
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()


def test_daily_refresh_catches_up(spark, bronze):
    from pitboss.plans import loads
    root = _tmp()
    names = ("fact_membership_day", "fact_player_session", "fact_session_day_by_table_game",
             "fact_session_day_by_agent_group", "fact_player_expenses", "fact_player_bonuses")
    tables = {n: os.path.join(root, n) for n in names}
    h1 = loads.daily_refresh(bronze, tables, dt.date(2024, 1, 17)).collect()[0]
    assert h1["has_rows"]
    days1 = {r[0] for r in spark.read.parquet(tables["fact_membership_day"]).select("gamingday").distinct().collect()}
    assert days1 == {dt.date(2024, 1, 17)}
    h2 = loads.daily_refresh(bronze, tables, dt.date(2024, 1, 20)).collect()[0]   # catch-up 17..20
    assert h2["has_rows"]
    days2 = {r[0] for r in spark.read.parquet(tables["fact_membership_day"]).select("gamingday").distinct().collect()}
    assert days2 == {dt.date(2024, 1, d) for d in range(17, 21)}
