"""Interval-overlap left join (visit x session), with optional interval ends.

The join keys ``keys`` (e.g. gaming day and member) are equi-keys, so Spark
plans a hash/sort-merge join with the time condition as a residual filter --
never a nested loop.  The condition distinguishes which session ends exist:

* both ends:    start <  v_out and finish >  v_in   (open overlap)
* start only:   start >= v_in  and start  <  v_out
* finish only:  finish > v_in  and finish <= v_out

A visit with a NULL end matches nothing (every comparison is NULL) and is
kept once with NULL session columns, as in any left join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlap_condition(v_in: Column, v_out: Column, s_start: Column, s_finish: Column) -> Column:
    both = s_start.isNotNull() & s_finish.isNotNull() & (s_start < v_out) & (s_finish > v_in)
    start_only = s_start.isNotNull() & s_finish.isNull() & (s_start >= v_in) & (s_start < v_out)
    finish_only = s_start.isNull() & s_finish.isNotNull() & (s_finish > v_in) & (s_finish <= v_out)
    return both | start_only | finish_only


def overlap_left_join(visits: DataFrame, sessions: DataFrame, keys: Sequence[str], v_in: str, v_out: str,
                      s_start: str, s_finish: str) -> DataFrame:
    """Every visit with each overlapping session (or once with NULLs)."""
    s = sessions.select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                        *[c for c in sessions.columns if c not in keys])
    on = [visits[k] == s[f"_s_{k}"] for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    cond = cond & overlap_condition(visits[v_in], visits[v_out], s[s_start], s[s_finish])
    return visits.join(s, cond, "left").drop(*[f"_s_{k}" for k in keys])


# Buckets of level k are HOURS[k] hours wide, aligned at 1970: an interval no
# longer than that lies in at most two neighbours.  The widest spans all time.
HOURS = tuple(4 ** k for k in range(14))


def _hour_index(ts: Column) -> Column:
    """Hours since 1970-01-01 of a timestamp without zone (monotone, no time zone)."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def _home_level(lo: Column, hi: Column) -> Column:
    """The finest level on which an interval touches at most two buckets."""
    out = F.lit(len(HOURS) - 1)
    for k in reversed(range(len(HOURS) - 1)):
        out = F.when(F.floor(hi / F.lit(HOURS[k])) - F.floor(lo / F.lit(HOURS[k])) <= 1, F.lit(k)).otherwise(out)
    return out


def _bucket(hour: Column, level: Column) -> Column:
    width = F.element_at(F.array(*[F.lit(h) for h in HOURS]), level + 1)
    return F.floor(hour / width)


def _spread(rows: DataFrame, others: Column) -> DataFrame:
    """``rows`` on the buckets they touch, on their own level and on those coarser
    ones that ``others`` (a bit per level) are at home on."""
    level = F.explode(F.filter(F.sequence(F.lit(0), F.lit(len(HOURS) - 1)), lambda k: (k == F.col("_level")) | (
        (k > F.col("_level")) & (F.bit_get(others, k) == 1))))
    out = rows.withColumn("_at", level)
    first, last = _bucket(F.col("_lo"), F.col("_at")), _bucket(F.col("_hi"), F.col("_at"))
    return out.withColumn("_first", first).withColumn("_bucket", F.explode(F.sequence(first, last)))


def overlap_left_join_bucketed(visits: DataFrame, sessions: DataFrame, keys: Sequence[str], visit_id: Sequence[str],
                               v_in: str, v_out: str, s_start: str, s_finish: str) -> DataFrame:
    """The same result as ``overlap_left_join``, without comparing every visit
    with every session of a key.

    Intervals of any length meet in one equi-join on ``(keys, level, bucket)``:
    time is cut into buckets of 1, 4, 16, ... hours, and an interval is at home
    on the finest level where it touches at most two of them.  It is put there,
    and on those coarser levels on which intervals of the other side of its key
    are at home.  Two intervals that share an hour share a bucket on the coarser
    one of their home levels, and only there, and the pair is emitted in the
    first bucket they share; so it appears once.  A member-day with very many
    visits and sessions is thereby split by time, and an interval of years
    costs a few rows, like any other.

    Intervals are normalised to (min, max) for bucketing: the three-branch
    condition implies that the normalised intervals intersect.  Visits without
    any match are added back once with NULL session columns (anti-join on
    ``visit_id``)."""
    vi, vo = F.col(v_in), F.col(v_out)
    ss, sf = F.col(s_start), F.col(s_finish)
    v = (visits.filter(vi.isNotNull() & vo.isNotNull())
         .withColumn("_lo", _hour_index(F.least(vi, vo))).withColumn("_hi", _hour_index(F.greatest(vi, vo)))
         .withColumn("_level", _home_level(F.col("_lo"), F.col("_hi"))))
    s = (sessions.filter(ss.isNotNull() | sf.isNotNull())       # least and greatest skip NULLs
         .withColumn("_lo", _hour_index(F.least(ss, sf))).withColumn("_hi", _hour_index(F.greatest(ss, sf)))
         .withColumn("_level", _home_level(F.col("_lo"), F.col("_hi"))))
    # one row per key that both sides have: on which levels they are at home
    bit = F.expr("shiftleft(1, _level)")
    homes = (v.select(*keys, bit.alias("_v_bit"), F.lit(0).alias("_s_bit"))
             .unionByName(s.select(*keys, F.lit(0).alias("_v_bit"), bit.alias("_s_bit")))
             .groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys])
             .agg(F.bit_or("_v_bit").alias("_v_homes"), F.bit_or("_s_bit").alias("_s_homes"))
             .filter("_v_homes > 0 AND _s_homes > 0"))

    def at_home(rows: DataFrame, others: str) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(k) == F.col(f"_k_{k}"))
        spread = _spread(rows.join(homes, same), F.col(others))
        return spread.drop("_v_homes", "_s_homes", *[f"_k_{k}" for k in keys])
    vb = at_home(v, "_s_homes")
    sb = at_home(s, "_v_homes")
    sb = sb.withColumnsRenamed({c: f"_s{c}" for c in ("_lo", "_hi", "_level", "_at", "_first", "_bucket")}
                               | {k: f"_s_{k}" for k in keys})
    cond = (F.col("_at") == F.col("_s_at")) & (F.col("_bucket") == F.col("_s_bucket"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_s_{k}"))
    cond = (cond & (F.col("_at") == F.greatest("_level", "_s_level"))
            & (F.col("_bucket") == F.greatest("_first", "_s_first"))
            & overlap_condition(F.col(v_in), F.col(v_out), F.col(s_start), F.col(s_finish)))
    work = ("_lo", "_hi", "_level", "_at", "_first", "_bucket")
    matched = vb.join(sb, cond, "inner").drop(*work, *[f"_s{c}" for c in work], *[f"_s_{k}" for k in keys])
    unmatched = visits.join(matched.select(*visit_id).distinct(), list(visit_id), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
