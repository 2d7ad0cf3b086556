"""Two-level (chunked) scans must equal the one-level windows exactly."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitboss.operators.dedupe import latest_per_key, upsert_last_wins
from pitboss.operators.scan import carry_last, chunked_row_number, max_prefix_sum, running_sum

SCHEMA = "k int, t timestamp_ntz, id int, v long, p int"


def _rows(seed, n=400):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, 4)     # key 0 is hot
        t = base + dt.timedelta(minutes=rnd.randint(0, 3000))
        out.append((k, t, i, rnd.randint(-50, 50), rnd.choice([None, None, rnd.randint(0, 9)])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chunked_equals_plain(spark, seed):
    df = spark.createDataFrame(_rows(seed), SCHEMA)
    order = [F.col("t"), F.col("id")]
    chunk = F.date_trunc("hour", "t")

    def as_map(d, col):
        return {r["id"]: r[col] for r in d.select("id", col).collect()}

    assert as_map(running_sum(df, ["k"], order, F.col("v"), "s", chunk), "s") == \
        as_map(running_sum(df, ["k"], order, F.col("v"), "s"), "s")
    assert as_map(chunked_row_number(df, ["k"], order, "rn", chunk), "rn") == \
        as_map(chunked_row_number(df, ["k"], order, "rn"), "rn")
    a = {r["k"]: r["m"] for r in max_prefix_sum(df, ["k"], order, F.col("v"), "m", chunk).collect()}
    b = {r["k"]: r["m"] for r in max_prefix_sum(df, ["k"], order, F.col("v"), "m").collect()}
    assert a == b
    for inclusive in (True, False):
        x = as_map(carry_last(df, ["k"], order, "p", "c", chunk, inclusive=inclusive), "c")
        y = as_map(carry_last(df, ["k"], order, "p", "c", inclusive=inclusive), "c")
        assert x == y


def test_latest_per_key_hot_copies(spark):
    rows = [(1, i, f"v{i}") for i in range(500)] + [(2, 3, "a"), (2, 1, "b")]
    df = spark.createDataFrame(rows, "k int, seq int, val string")
    got = {r["k"]: r["val"] for r in latest_per_key(df, ["k"], [F.col("seq")]).collect()}
    assert got == {1: "v499", 2: "a"}


def test_upsert_batch_wins_and_untouched_kept(spark):
    target = spark.createDataFrame([(1, 5, "old"), (2, 5, "keep")], "k int, seq int, val string")
    batch = spark.createDataFrame([(1, 1, "new-low"), (1, 2, "new"), (3, 1, "ins")], "k int, seq int, val string")
    got = {r["k"]: r["val"] for r in upsert_last_wins(target, batch, ["k"], F.col("seq")).collect()}
    assert got == {1: "new", 2: "keep", 3: "ins"}


def test_upsert_null_key_matches(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 3, "c")], "k int, seq int, val string")
    got = latest_per_key(df, [F.coalesce(F.col("k"), F.lit(-1))], [F.col("seq")]).collect()
    assert sorted(r["val"] for r in got) == ["b", "c"]


@pytest.mark.parametrize("seed", [7, 8])
def test_bucketed_overlap_equals_plain(spark, seed):
    from pitboss.operators.overlap import overlap_left_join, overlap_left_join_bucketed
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 5)
    day = dt.date(2024, 1, 5)

    def t():
        if rnd.random() < 0.1:
            return None
        span = 2000 if rnd.random() < 0.9 else 9000      # some intervals longer than 48 hours
        return base + dt.timedelta(minutes=rnd.randint(0, span))

    visits = [(day, rnd.randint(1, 3), i, t(), t()) for i in range(60)]
    sessions = [(day, rnd.randint(1, 3), j, t(), t()) for j in range(120)]
    v = spark.createDataFrame(visits, "gaming_day date, membership long, visit_no int, time_in timestamp_ntz, time_out timestamp_ntz")
    s = spark.createDataFrame(sessions, "gaming_day date, membership long, sid int, timestart timestamp_ntz, timefinish timestamp_ntz")
    args = ("time_in", "time_out", "timestart", "timefinish")
    plain = sorted((r["visit_no"], r["sid"] if r["sid"] is not None else -1)
                   for r in overlap_left_join(v, s, ["gaming_day", "membership"], *args).collect())
    bucketed = sorted((r["visit_no"], r["sid"] if r["sid"] is not None else -1)
                      for r in overlap_left_join_bucketed(v, s, ["gaming_day", "membership"],
                                                          ["gaming_day", "membership", "visit_no"], *args).collect())
    assert plain == bucketed


def test_bucketed_overlap_of_any_length(spark):
    """Minutes, days and centuries on both sides of one key, ends swapped or missing."""
    from pitboss.operators.overlap import overlap_left_join, overlap_left_join_bucketed
    rnd = random.Random(11)

    def ends():
        start = dt.datetime(1969, 12, 31, 22) + dt.timedelta(minutes=rnd.choice([0, 59, 60, 120, 10_000]) + rnd.randint(0, 600))
        end = start + dt.timedelta(minutes=rnd.choice([1, 59, 60, 240, 960, 4_000, 70_000, 50_000_000, -30]))
        return tuple(x if rnd.random() > 0.05 else None for x in (start, end))
    v = spark.createDataFrame([(1, i, *ends()) for i in range(150)], "k int, visit_no int, a timestamp_ntz, b timestamp_ntz")
    s = spark.createDataFrame([(1, i, *ends()) for i in range(150)] + [(2, 999, *ends())],
                              "k int, sid int, c timestamp_ntz, d timestamp_ntz")
    args = ("a", "b", "c", "d")
    both = [sorted((r["visit_no"], r["sid"] if r["sid"] is not None else -1) for r in out.collect()) for out in (
        overlap_left_join(v, s, ["k"], *args), overlap_left_join_bucketed(v, s, ["k"], ["k", "visit_no"], *args))]
    assert both[0] == both[1] and len(both[0]) > 3000


def test_reconcile_two_sided(spark, bronze):
    from pitboss.plans import gold
    from pitboss.sources.adapters import FROM_DAY, TO_DAY
    rep = gold.visit_sessions(bronze, FROM_DAY, TO_DAY)
    kept = rep.filter(F.col("membership") % 17 != 0)
    doubled = kept.filter(F.col("membership") % 19 == 0)
    diff = gold.reconcile(rep, kept.unionByName(doubled))
    copies = {r["side"]: r["n"] for r in diff.groupBy("side").agg(F.sum("n").alias("n")).collect()}
    assert copies == {"only_in_legacy": rep.count() - kept.count(), "only_in_generated": doubled.count()}
    assert gold.reconcile(rep, rep).count() == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_pool_trace_chunked_equals_plain(spark, seed):
    from decimal import Decimal
    from pitboss.operators.pool import pool_trace
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 5)
    rows = []
    for i in range(300):
        t = None if rnd.random() < 0.05 else base + dt.timedelta(minutes=rnd.randint(0, 1500))
        buy = Decimal(rnd.randint(0, 100)) if rnd.random() < 0.5 else Decimal(0)
        out = Decimal(0) if buy else Decimal(rnd.randint(0, 100))
        rows.append((dt.date(2024, 1, 5), rnd.randint(1, 3), t, i, buy, out))
    ev = spark.createDataFrame(rows, "gamingday date, membership long, timeoper timestamp_ntz, idoper long, "
                                     "buyamt decimal(19,4), outamt decimal(19,4)")
    cols = ["idoper", "s", "mins", "poolafter", "poolbefore", "clean"]
    keys = ["gamingday", "membership"]
    a = sorted(tuple(r) for r in pool_trace(ev, keys, "timeoper", "idoper", split_hot_groups=True).select(cols).collect())
    b = sorted(tuple(r) for r in pool_trace(ev, keys, "timeoper", "idoper", split_hot_groups=False).select(cols).collect())
    assert a == b


@pytest.mark.parametrize("unit", ["day", "hour"])
def test_asof_split_equals_plain(spark, unit):
    from pitboss.operators.asof import agent_at
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 5)
    hist = []
    for m in (1, 2, 3):
        # member 1 is hot; (member, datechange) is unique, as after the upsert
        for minute in rnd.sample(range(4000), 60 if m == 1 else 5):
            t = base + dt.timedelta(minutes=minute)
            hist.append((m, t, t, rnd.choice([None, 0, 1, 2, 3])))
    probes = [(i, rnd.choice([1, 1, 1, 2, 3, 4]), None if rnd.random() < 0.05 else
               base + dt.timedelta(minutes=rnd.randint(-200, 4200))) for i in range(300)]
    h = spark.createDataFrame(hist, "membership long, datechange timestamp_ntz, created timestamp_ntz, idagent int")
    p = spark.createDataFrame(probes, "pid int, membership long, ts timestamp_ntz")
    pl = spark.createDataFrame([(1, 7), (2, 0), (3, None), (4, 5)], "membership long, idagent int")
    a = {r["pid"]: r["idagent"] for r in agent_at(p, h, pl, "membership", "ts", split_by_day=True,
                                                  chunk_unit=unit).collect()}
    b = {r["pid"]: r["idagent"] for r in agent_at(p, h, pl, "membership", "ts").collect()}
    assert a == b and len(a) == 300


def test_busy_hours_are_split_by_rank(spark):
    """Many rows of one member in one hour, a third of them at one instant, some without a time:
    every scan equals its plain form, and the busy hour lies in many small chunks."""
    from pitboss.operators.asof import asof_last
    from pitboss.operators.pool import clean_drop, hour_chunk, pool_trace
    from pitboss.operators.scan import balanced_chunks, carry_last, chunked_row_number, nulls_last, running_sum
    n, at = 60_000, "timestamp_ntz'2024-01-05 10:00:00'"
    late = f"{at} + make_dt_interval(0, 0, 0, cast(pmod(xxhash64(id), 3600) AS decimal(18,6)))"
    ev = spark.range(n).selectExpr(
        "CASE WHEN id % 100 = 0 THEN NULL WHEN id % 50 = 1 THEN 2 ELSE 1 END AS k", "id",
        f"CASE WHEN id % 3 = 0 THEN {at} WHEN id % 500 = 1 THEN NULL ELSE {late} END AS t",
        "CAST(pmod(xxhash64(id, 1), 9) AS decimal(19,4)) AS buyamt", "CAST(pmod(xxhash64(id, 2), 9) AS decimal(19,4)) AS outamt")
    order = [F.col("t").asc_nulls_last(), F.col("id").asc()]
    place = [*nulls_last(F.col("t")), F.col("id")]
    d, chunk = balanced_chunks(ev, ["k"], place, hour_chunk("t"), chunk_rows=2_000)
    d = d.withColumn("c", chunk)
    sizes = d.groupBy("k", "c").count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < n / 5 and sum(r["count"] for r in sizes) == n

    def equal(a, b):
        cols = sorted(a.columns)
        assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and a.count() == b.count()
    value = F.col("buyamt") - F.col("outamt")
    equal(running_sum(ev, ["k"], order, value, "s"), running_sum(d, ["k"], order, value, "s", F.col("c")).drop("c", "_sub"))
    equal(chunked_row_number(ev, ["k"], order, "no"), chunked_row_number(d, ["k"], order, "no", F.col("c")).drop("c", "_sub"))
    payload = F.when(F.col("id") % 7 == 0, F.struct("id"))
    plain = carry_last(ev.withColumn("p", payload), ["k"], [F.col("t"), F.col("id")], "p", "last")
    split, cut = balanced_chunks(ev.withColumn("p", payload), ["k"], [F.col("t"), F.col("id")],
                                 F.coalesce(F.date_trunc("hour", F.col("t")), F.lit("0001-01-01").cast("timestamp_ntz")),
                                 chunk_rows=2_000)
    equal(plain, carry_last(split, ["k"], [F.col("t"), F.col("id")], "p", "last", cut).drop("_sub"))
    import pitboss.operators.scan as scan
    before, scan.balanced_chunks.__defaults__ = scan.balanced_chunks.__defaults__, (None, 2_000)
    try:
        equal(clean_drop(ev, ["k"], "t", "id"), clean_drop(ev, ["k"], "t", "id", split_hot_groups=False))
        equal(pool_trace(ev, ["k"], "t", "id"), pool_trace(ev, ["k"], "t", "id", split_hot_groups=False))
        hist = spark.range(40).selectExpr("id % 3 AS k", f"{at} + make_dt_interval(0, 0, cast(id * 2 AS int)) AS since", "id AS x")
        probe = ev.select("k", "id", "t")
        equal(asof_last(probe, hist, ["k"], "t", "since", ["x"]),
              asof_last(probe, hist, ["k"], "t", "since", ["x"], split_by_day=True, chunk_unit="hour", counted=probe))
    finally:
        scan.balanced_chunks.__defaults__ = before


def test_without_busy_groups_the_plan_is_unchanged(spark):
    from pitboss.operators.pool import hour_chunk
    from pitboss.operators.scan import balanced_chunks
    ev = spark.range(100).selectExpr("id % 3 AS k", "id", "timestamp_ntz'2024-01-05 10:00:00' AS t")
    d, _ = balanced_chunks(ev, ["k"], [F.col("t"), F.col("id")], hour_chunk("t"))
    assert d is ev
