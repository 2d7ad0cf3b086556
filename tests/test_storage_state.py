"""Whole stored state after write, re-write, NULL day, moved key, purge and first run."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pitboss.operators.asof import asof_last
from pitboss.operators.scan import running_sum
from pitboss.sources import ingest, sinks

D = [dt.date(2024, 1, d) for d in range(1, 8)]
SCH = "gamingday date, membership long, idagent long, v long"


def _path(name="t"):
    return os.path.join(tempfile.mkdtemp(prefix="pitboss-test-"), name)


def _state(spark, path, cols=("gamingday", "membership", "idagent", "v")):
    return sorted((tuple(r[c] for c in cols) for r in spark.read.parquet(path).collect()), key=str)


def _days(path):
    return sorted(d for d in os.listdir(path) if d.startswith("gamingday="))


def test_upsert_keeps_null_partition(spark):
    path = _path()
    spark.createDataFrame([(None, 1, 0, 1), (None, 2, 0, 2), (D[0], 3, 0, 3)], SCH).write.partitionBy("gamingday").parquet(path)
    batch = spark.createDataFrame([(None, 9, 0, 9)], SCH)
    for _ in range(2):
        sinks.write_upsert(batch, path, ["membership"], F.col("v"), ["gamingday"])
        assert _state(spark, path) == sorted([(None, 1, 0, 1), (None, 2, 0, 2), (None, 9, 0, 9), (D[0], 3, 0, 3)], key=str)


def test_upsert_moves_a_key_between_partitions(spark):
    path = _path()
    spark.createDataFrame([(D[0], 1, 0, 1), (D[1], 2, 0, 1), (D[1], 3, 0, 1), (D[2], None, 0, 1)], SCH) \
        .write.partitionBy("gamingday").parquet(path)
    batch = spark.createDataFrame([(D[3], 1, 0, 2), (D[1], 3, 0, 2), (D[3], None, 0, 2)], SCH)
    for _ in range(2):
        sinks.write_upsert(batch, path, ["membership"], F.col("v"), ["gamingday"])
        assert _state(spark, path) == sorted([(D[3], 1, 0, 2), (D[1], 2, 0, 1), (D[1], 3, 0, 2), (D[3], None, 0, 2)], key=str)
        assert _days(path) == ["gamingday=2024-01-02", "gamingday=2024-01-04"]


def test_scoped_refresh_of_a_new_table(spark):
    path = _path()
    new = spark.createDataFrame([(D[0], 1, 6, 1), (D[1], 2, 7, 1)], SCH)
    sinks.write_scoped_refresh(new, path, "gamingday", D[0], D[1], "idagent", 6, ["gamingday", "membership"])
    assert _state(spark, path) == [(D[0], 1, 6, 1)]


@pytest.mark.parametrize("mode", sinks.ARCHIVE_MODES)
def test_purge_keeps_the_layout(spark, mode):
    path, archive = _path(), _path("archive")
    rows = [(D[k], m, 1, k) for k in range(5) for m in (1, 2)] + [(None, 5, 1, 0)]
    spark.createDataFrame(rows, SCH).write.partitionBy("gamingday").parquet(path)
    for _ in range(2):
        sinks.archive_or_purge(spark, {"t": (path, F.col("gamingday"))}, D[2], mode, archive)
        kept = [r for r in rows if r[0] is None or r[0] >= D[2]]
        assert _state(spark, path) == sorted(kept, key=str)
    if mode == "archive_delete":
        assert spark.read.parquet(archive + "/t").count() == 4
    # a refresh after the purge meets the same layout
    emptied = sinks.write_range_refresh(spark.createDataFrame([(D[3], 7, 1, 7)], SCH), path, "gamingday", D[3], D[4])
    assert emptied == [D[4]]
    assert _state(spark, path) == sorted([r for r in kept if r[0] not in (D[3], D[4])] + [(D[3], 7, 1, 7)], key=str)
    assert _days(path) == ["gamingday=2024-01-03", "gamingday=2024-01-04", "gamingday=__HIVE_DEFAULT_PARTITION__"]


def test_purge_rewrites_a_mixed_partition(spark):
    path = _path()
    df = spark.createDataFrame([(D[0], 1, 1, 1), (D[4], 1, 1, 2), (D[4], 2, 2, 3)], SCH)
    df.write.partitionBy("idagent").parquet(path)
    sinks.archive_or_purge(spark, {"t": (path, F.col("gamingday"))}, D[2], "delete_only")
    assert _state(spark, path) == sorted([(D[4], 1, 1, 2), (D[4], 2, 2, 3)], key=str)
    assert sinks.partition_columns(spark, path) == ["idagent"]


def test_chunked_scans_equal_plain_with_nulls(spark):
    rows = [(k, i, None if i % 3 == 1 else i) for k in (1, None) for i in range(8)] + [(2, 0, None), (2, 5, None)]
    df = spark.createDataFrame(rows, "k int, i int, v long")
    order = [F.col("i")]
    plain = running_sum(df, ["k"], order, F.col("v"), "s")
    split = running_sum(df, ["k"], order, F.col("v"), "s", chunk=(F.col("i") / 2).cast("int"))
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, split.select(plain.columns).collect()), key=str)
    with pytest.raises(Exception, match="chunk"):
        running_sum(df, ["k"], order, F.col("v"), "s", chunk=F.col("v")).collect()


def test_asof_split_equals_plain_with_null_keys(spark):
    t = [dt.datetime(2024, 1, d, 12) for d in range(1, 6)]
    probe = spark.createDataFrame([(1, t[2]), (None, t[2]), (1, None), (2, t[0])], "k int, at timestamp_ntz")
    hist = spark.createDataFrame([(1, t[0], "a"), (1, t[1], None), (None, t[0], "n"), (2, t[3], "late")],
                                 "k int, since timestamp_ntz, x string")
    out = []
    for split in (False, True):
        rows = asof_last(probe, hist, ["k"], "at", "since", ["x"], split_by_day=split).collect()
        out.append(sorted(((r["k"], r["at"], None if r["asof"] is None else ("hit", r["asof"]["x"])) for r in rows),
                          key=str))
    assert out[0] == out[1] and len(out[0]) == 4


def test_visit_without_times_is_numbered_last(spark):
    from types import SimpleNamespace

    from pitboss.plans import gold, silver
    visits = spark.createDataFrame(
        [(D[0], 1, None, None, None), (D[0], 1, dt.datetime(2024, 1, 1, 20), None, dt.datetime(2024, 1, 1, 20))],
        "datework date, membership long, time_in timestamp_ntz, time_out timestamp_ntz, created timestamp_ntz")
    original = silver.visits_in_range
    silver.visits_in_range = lambda b, f, t: b.visits
    try:
        out = gold.numbered_visits(SimpleNamespace(visits=visits), D[0], D[0]).collect()
    finally:
        silver.visits_in_range = original
    assert sorted((r["visit_no"], r["time_in"] is None) for r in out) == [(1, False), (2, True)]


def test_wide_multiplier(spark):
    from decimal import Decimal

    from pitboss.functions.decimals import adt_product
    row = spark.range(1).select(adt_product(F.lit(Decimal("100000.5")), F.lit(Decimal("2.0000")), F.lit(Decimal(3)),
                                            F.lit(Decimal("1.5000"))).alias("x"),
                                adt_product(F.lit(Decimal("0.0266")), F.lit(Decimal("0.6237")), F.lit(Decimal(30)),
                                            F.lit(Decimal("87.9133"))).alias("y")).first()
    assert row["x"] == Decimal("900004.5000") and row["y"] == Decimal("43.7556")


def test_failed_source_is_logged_and_the_next_goes_on(spark):
    root = _path("load")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    job = {"target_path": f"{root}/{{}}", "control_path": f"{root}/control", "log_path": f"{root}/log",
           "seq": F.col("id"), "run_at": dt.datetime(2024, 1, 1)}
    jobs = [job | {"source": rows, "cfg": ingest.SourceConfig(name, cols, "id", "int"), "target_path": f"{root}/{name}"}
            for name, cols in (("broken", ("id", "missing")), ("visits", ("id", "x")))]
    errors = ingest.run_sources(spark, jobs)
    assert errors["visits"] is None and "missing" in errors["broken"]
    log = {r["source_table"]: r["status"] for r in spark.read.parquet(f"{root}/log").collect()}
    assert log == {"broken": "failed", "visits": "success"}


def test_append_repeated_before_the_watermark_moves(spark, monkeypatch):
    root = _path("append")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    cfg = ingest.SourceConfig("visits", ("id", "x"), "id", "int")
    args = (rows, cfg, f"{root}/visits", f"{root}/control", f"{root}/log", F.col("id"), dt.datetime(2024, 1, 1))
    with monkeypatch.context() as m:
        m.setattr(ingest, "advance_watermark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.run_incremental(spark, *args)
    for _ in range(2):
        ingest.run_incremental(spark, *args)
        assert spark.read.parquet(f"{root}/visits").count() == 2


def test_daily_refresh_recovers_from_a_failed_load(spark, bronze, monkeypatch):
    from pitboss.plans import loads
    root = _path("daily")
    names = ("fact_membership_day", "fact_player_session", "fact_session_day_by_table_game",
             "fact_session_day_by_agent_group", "fact_player_expenses", "fact_player_bonuses", "dim_game",
             "dim_agent_group_scd", "dim_table")
    tables = {n: os.path.join(root, n) for n in names}
    loads.daily_refresh(bronze, tables, dt.date(2024, 1, 17))
    with monkeypatch.context() as m:
        m.setattr(loads, "load_player_expenses", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            loads.daily_refresh(bronze, tables, dt.date(2024, 1, 19))
    loads.daily_refresh(bronze, tables, dt.date(2024, 1, 19))
    for n in ("fact_membership_day", "fact_player_expenses", "fact_player_bonuses"):
        days = {r[0] for r in spark.read.parquet(tables[n]).select("gamingday").distinct().collect()}
        assert days == {dt.date(2024, 1, d) for d in (17, 18, 19)}, n
