"""Hand-written edge cases of the warehouse semantics (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitboss.functions.classify import agent_label_loose, agent_label_strict, expense_flags, expense_type_key
from pitboss.functions.decimals import adt_product
from pitboss.functions.positions import floor_zone, ip_readable, position_in_zone, status_by_age
from pitboss.operators.asof import agent_at
from pitboss.operators.overlap import overlap_left_join
from pitboss.operators.pool import clean_drop, pool_trace
from pitboss.plans import positions as pos

T0 = dt.datetime(2024, 1, 5, 10, 0)
DROP_SCHEMA = "gamingday date, membership long, timeoper timestamp_ntz, idoper long, buyamt decimal(19,4), outamt decimal(19,4)"


def _events(spark, rows):
    day = dt.date(2024, 1, 5)
    data = [(day, 1, T0 + dt.timedelta(minutes=m), i, Decimal(b), Decimal(o)) for i, (m, b, o) in enumerate(rows)]
    return spark.createDataFrame(data, DROP_SCHEMA)


@pytest.mark.parametrize("split", [True, False])
def test_clean_drop_pool_a(spark, split):
    ev = _events(spark, [(0, 100, 0), (1, 0, 60), (2, 50, 0), (3, 50, 0)])
    res = clean_drop(ev, ["gamingday", "membership"], "timeoper", "idoper", split_hot_groups=split).collect()
    assert res[0]["totaldrop_clean"] == Decimal("140.0000")
    trace = pool_trace(ev, ["gamingday", "membership"], "timeoper", "idoper").orderBy("idoper").collect()
    assert [r["poolafter"] for r in trace] == [Decimal(0), Decimal(60), Decimal(10), Decimal(0)]
    assert sum(r["clean"] for r in trace) == Decimal(140)


def test_clean_drop_cash_out_first(spark):
    ev = _events(spark, [(0, 0, 30), (1, 20, 0)])
    assert clean_drop(ev, ["gamingday", "membership"], "timeoper", "idoper").collect()[0][2] == Decimal(0)


def test_clean_drop_same_time_orders_by_id(spark):
    day = dt.date(2024, 1, 5)
    rows = [(day, 1, T0, 2, Decimal(50), Decimal(0)), (day, 1, T0, 1, Decimal(0), Decimal(50))]
    ev = spark.createDataFrame(rows, DROP_SCHEMA)
    # the cash-out (id 1) comes first, so the buy-in is covered by the pool
    assert clean_drop(ev, ["gamingday", "membership"], "timeoper", "idoper").collect()[0][2] == Decimal(0)


def test_clean_drop_null_time_sorts_last(spark):
    day = dt.date(2024, 1, 5)
    rows = [(day, 1, None, 1, Decimal(0), Decimal(70)), (day, 1, T0, 2, Decimal(50), Decimal(0))]
    ev = spark.createDataFrame(rows, DROP_SCHEMA)
    for split in (True, False):
        got = clean_drop(ev, ["gamingday", "membership"], "timeoper", "idoper", split_hot_groups=split).collect()
        assert got[0][2] == Decimal(50)


HIST = "membership long, datechange timestamp_ntz, created timestamp_ntz, idagent int"


@pytest.mark.parametrize("split", [True, False])
def test_asof_inclusive(spark, split):
    t = [dt.datetime(2024, 1, d) for d in range(1, 7)]
    hist = spark.createDataFrame([(1, t[1], t[1], 10), (1, t[5], t[5], 11)], HIST)
    probes = spark.createDataFrame([(i, 1, t[d]) for i, d in enumerate([0, 1, 3, 5])], "pid int, membership long, ts timestamp_ntz")
    players = spark.createDataFrame([(1, None)], "membership long, idagent int")
    got = {r["pid"]: r["idagent"] for r in agent_at(probes, hist, players, "membership", "ts", split_by_day=split).collect()}
    assert got == {0: None, 1: 10, 2: 10, 3: 11}


def test_asof_null_latest_falls_back_and_zero_rules(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    hist = spark.createDataFrame([(1, t1, t1, 7), (1, t2, t2, None), (2, t1, t1, 0)], HIST)
    probes = spark.createDataFrame([(1, t2), (2, t2), (3, t2)], "membership long, ts timestamp_ntz")
    players = spark.createDataFrame([(1, 4), (2, 9), (3, 0)], "membership long, idagent int")
    got = {r["membership"]: r["idagent"] for r in agent_at(probes, hist, players, "membership", "ts").collect()}
    # NULL in the latest row -> player's agent; history 0 stays 0; player 0 -> none
    assert got == {1: 4, 2: 0, 3: None}


def test_agent_labels(spark):
    df = spark.createDataFrame([(1, ""), (2, "NO AGENT"), (3, None), (None, "X"), (5, "Bob")], "idagent int, name string")
    rows = df.select(agent_label_strict(F.col("idagent"), F.col("name")).alias("s"),
                     agent_label_loose(F.col("idagent"), F.col("name")).alias("l")).collect()
    assert [r["s"] for r in rows] == ["NO AGENT", "NO AGENT", "NO AGENT", "NO AGENT", "Bob"]
    assert [r["l"] for r in rows] == ["", "NO AGENT", "NO AGENT", "NO AGENT", "Bob"]


VIS = "gaming_day date, membership long, visit_no int, time_in timestamp_ntz, time_out timestamp_ntz"
SES = "gaming_day date, membership long, sid int, timestart timestamp_ntz, timefinish timestamp_ntz"


def test_overlap_touching_end(spark):
    d = dt.date(2024, 1, 5)
    vin, vout = dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 12)
    visits = spark.createDataFrame([(d, 1, 1, vin, vout)], VIS)
    sessions = spark.createDataFrame([
        (d, 1, 1, vout, vout + dt.timedelta(hours=1)),        # both ends, starts at visit end: no
        (d, 1, 2, None, vout),                                 # finish only, at visit end: yes
        (d, 1, 3, vout, None),                                 # start only, at visit end: no
        (d, 1, 4, vin, None),                                  # start only, at visit start: yes
    ], SES)
    got = sorted(r["sid"] for r in overlap_left_join(visits, sessions, ["gaming_day", "membership"], "time_in",
                                                      "time_out", "timestart", "timefinish").collect())
    assert got == [2, 4]


def test_overlap_null_visit_end_keeps_one_row(spark):
    d = dt.date(2024, 1, 5)
    visits = spark.createDataFrame([(d, 1, 1, dt.datetime(2024, 1, 5, 10), None)], VIS)
    sessions = spark.createDataFrame([(d, 1, 1, dt.datetime(2024, 1, 5, 11), dt.datetime(2024, 1, 5, 12))], SES)
    rows = overlap_left_join(visits, sessions, ["gaming_day", "membership"], "time_in", "time_out", "timestart",
                             "timefinish").collect()
    assert len(rows) == 1 and rows[0]["sid"] is None


def test_adt_exact(spark):
    df = spark.createDataFrame([(Decimal("0.0266"), Decimal("0.6237"), 30, Decimal("87.9133"))],
                               "m decimal(19,4), h decimal(19,4), n int, a decimal(19,4)")
    assert df.select(adt_product("m", "h", "n", "a")).collect()[0][0] == Decimal("43.7556")
    naive = df.select((F.col("m") * F.col("h") * F.col("n") * F.col("a")).cast("decimal(19,4)")).collect()[0][0]
    assert naive == Decimal("43.7555")  # why the narrowing exists


def test_expense_both_categories(spark):
    df = spark.createDataFrame([(641, 1, "Air Ticket + Hotel"), (641, 1, None), (153, 1, "x"), (153, -1, "x")],
                               "acc int, dir int, comment string")
    fl = expense_flags(F.coalesce(F.col("comment"), F.lit("")))
    rows = df.select(*[v.alias(k) for k, v in fl.items()],
                     expense_type_key(F.col("acc"), F.col("dir"), F.col("comment")).alias("k")).collect()
    assert (rows[0]["air"], rows[0]["hotel"], rows[0]["discount_plus"], rows[0]["other"]) == (True, True, False, False)
    assert rows[0]["k"] == 1
    assert rows[1]["other"] and rows[1]["k"] == 4   # NULL comment: 'other', key 4
    assert [rows[2]["k"], rows[3]["k"]] == [5, 6]


def test_position_label(spark):
    r = spark.createDataFrame([(167838470,)], "ip int").select(
        ip_readable("ip").alias("t"), floor_zone("ip").alias("z"), position_in_zone("ip").alias("p")).collect()[0]
    assert (r["t"], r["z"], r["p"]) == ("10.1.3.6", 3, 6)


def test_status_edges(spark):
    as_of = dt.date(2024, 6, 1)
    days = [as_of - dt.timedelta(days=n) for n in (7, 8, 90, 91)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(status_by_age(F.col("d"), as_of, "Decommissioned", "Config Only")).collect()]
    assert got == ["Active", "Recently Inactive", "Recently Inactive", "Decommissioned", "Config Only"]


def test_islands_gap_three_continues_four_splits(spark):
    base = dt.date(2024, 1, 1)
    days = [0, 3, 7]       # gap 3 -> same period; gap 4 -> new period
    meter = spark.createDataFrame([(1, 5, base + dt.timedelta(days=d), dt.datetime(2024, 1, 1) + dt.timedelta(days=d))
                                   for d in days], "ipaddr int, macaddr long, gamingday date, generated timestamp_ntz")
    per = pos.machine_periods(meter, dt.date(2024, 1, 31)).orderBy("period_start").collect()
    assert [(r["period_start"], r["days_active"]) for r in per] == [(base, 2), (base + dt.timedelta(days=7), 1)]
