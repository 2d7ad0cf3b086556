"""Invariants on the sf0.01 tables and physical-plan checks."""

import pytest
from pyspark.sql import functions as F

from pitboss.catalog.entries_positions import AS_OF
from pitboss.plans import gold, positions as pos, silver
from pitboss.sources import sinks
from pitboss.sources.adapters import FROM_DAY, TO_DAY


def test_clean_drop_bounded_by_cash_in(bronze):
    md = silver.membership_day(bronze, FROM_DAY, TO_DAY)
    bad = md.filter((F.col("totaldrop_clean") < 0) | (F.col("totaldrop_clean") > F.col("totalcash_in"))).count()
    assert bad == 0


def test_member_day_key_unique_and_not_null(bronze):
    md = silver.membership_day(bronze, FROM_DAY, TO_DAY)
    assert md.groupBy("gamingday", "membership").count().filter("count > 1").count() == 0
    assert md.filter(F.col("totalcash_in").isNull() | F.col("sessionscnt").isNull()).count() == 0


def test_period_equals_sum_of_days(bronze):
    md = silver.membership_day(bronze, FROM_DAY, TO_DAY)
    per = gold.membership_period(bronze, FROM_DAY, TO_DAY, day_fact=md)
    a = md.agg(F.sum("slot_totalbet"), F.count(F.lit(1))).collect()[0]
    b = per.agg(F.sum("slot_totalbet"), F.sum("visitsdays")).collect()[0]
    assert tuple(a) == tuple(b)


def test_island_days_add_up(bronze):
    meter = bronze.meter_day
    per = pos.machine_periods(meter, AS_OF)
    days = pos.plausible_meter(meter).select("ipaddr", "gamingday").distinct().count()
    assert per.agg(F.sum("days_active")).collect()[0][0] == days


def test_range_refresh_twice_equals_once(bronze):
    from pitboss.catalog.entries_ingest import visit_day_aggregate
    old = visit_day_aggregate(bronze.visits)
    new = visit_day_aggregate(bronze.visits.filter(F.col("datework") != F.lit("2024-01-10").cast("date")))
    once = sinks.refresh_range_state(old, new, "gamingday", FROM_DAY, TO_DAY)
    twice = sinks.refresh_range_state(once, new, "gamingday", FROM_DAY, TO_DAY)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.filter(F.col("gamingday") == F.lit("2024-01-10").cast("date")).count() == 0


FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", ["membership_day", "asof_agent", "player_expenses", "player_bonuses",
                                  "visit_sessions", "player_session", "machine_history", "machine_periods",
                                  "clean_drop", "reconcile_multiset", "dim_position"])
def test_plans_have_no_nested_loops_or_python(spark, name):
    from __spark_entry__ import queries
    df = queries()[name](spark, "/root/testdata/sf0.01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_membership_day_scans_are_pruned(spark):
    from __spark_entry__ import queries
    df = queries()["membership_day"](spark, "/root/testdata/sf0.01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props" \
        not in plan   # the unused props column is never read
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan


def test_key_checks(spark, bronze):
    from pitboss.operators.keys import assert_key, assert_not_null, key_violations, orphans
    md = silver.membership_day(bronze, FROM_DAY, TO_DAY)
    assert_key(md, ["gamingday", "membership"], "fact_membership_day")
    assert_not_null(md, ["totaldrop_clean", "sessionscnt"], "fact_membership_day")
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert key_violations(dup, ["k"]).count() == 2
    with pytest.raises(ValueError):
        assert_key(dup, ["k"])
    fact = spark.createDataFrame([(1,), (9,)], "k int")
    assert [r["k"] for r in orphans(fact, dup, ["k"]).collect()] == [9]


def test_scale_conf_sizes_partitions():
    from pitboss.session import scale_conf
    small = scale_conf(10 * 1024 ** 2)
    big = scale_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_forked_inputs_reuse_their_shuffles(spark):
    """The overlap join reads the numbered visits in three branches; AQE must
    reuse their shuffle stages rather than recompute them."""
    from __spark_entry__ import queries
    df = queries()["overlap_join"](spark, "/root/testdata/sf0.01")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") > 0
