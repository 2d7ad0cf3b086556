"""Floor positions: activity summary, position dimension, machine history and periods.

Positions are packed IPv4 integers.  The reference day for status labels is a
parameter (``as_of``), never the wall clock, so results are reproducible.
Per-machine and per-position ordered scans use the chunked scans of
``pitboss.operators.scan``: one machine or one position may carry a large
share of all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.positions import floor_zone, ip_readable, position_in_zone, status_by_age
from ..functions.predicates import BRIDGE_OPEN_END
from ..operators.dedupe import latest_per_key
from ..operators.scan import carry_last, running_sum

# Plausible-date guard of the meter log.
MIN_PLAUSIBLE = dt.date(2000, 1, 1)
MAX_PLAUSIBLE = dt.date(2100, 1, 1)
NEW_PERIOD_GAP_DAYS = 3


def _lit_date(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def meter_activity(meter: DataFrame) -> DataFrame:
    """Meter activity per position (D11, B18): strict bounds on min/max, inclusive in the count."""
    day = F.col("gamingday")
    return meter.groupBy("ipaddr").agg(
        F.min(F.when(day > _lit_date(MIN_PLAUSIBLE), day)).alias("first_seen_meter"),
        F.max(F.when(day < _lit_date(MAX_PLAUSIBLE), day)).alias("last_seen_meter"),
        F.countDistinct(F.when(day.between(_lit_date(MIN_PLAUSIBLE), _lit_date(MAX_PLAUSIBLE)), day))
        .cast("int").alias("total_meter_days"))


def session_activity(sessions: DataFrame) -> DataFrame:
    """Session activity per position."""
    return sessions.groupBy("ipaddr").agg(F.min("gamingday").alias("first_seen_session"),
                                          F.max("gamingday").alias("last_seen_session"),
                                          F.count(F.lit(1)).alias("total_sessions"))


def plausible_meter(meter: DataFrame) -> DataFrame:
    return meter.filter(F.col("gamingday").between(_lit_date(MIN_PLAUSIBLE), _lit_date(MAX_PLAUSIBLE)))


def latest_mac(meter: DataFrame) -> DataFrame:
    """Latest machine per position (E7): latest day, then latest generated
    (then highest machine id, to make the pick total)."""
    m = plausible_meter(meter)
    best = latest_per_key(m.select("ipaddr", "macaddr", "gamingday", "generated"), ["ipaddr"],
                          [F.col("gamingday"), F.col("generated").isNotNull(), F.col("generated"), F.col("macaddr")])
    return best.select("ipaddr", F.col("macaddr").alias("latest_macaddr"))


def egd_activity(meter: DataFrame, sessions: DataFrame) -> DataFrame:
    """Activity summary (A16): meter FULL OUTER sessions on the position (C9),
    plus the latest machine."""
    m, s = meter_activity(meter), session_activity(sessions)
    j = m.join(s, "ipaddr", "full")   # USING join: ipaddr is coalesced
    return j.join(latest_mac(meter), "ipaddr", "left").select(
        "ipaddr", "first_seen_meter", "last_seen_meter",
        F.coalesce(F.col("total_meter_days"), F.lit(0)).cast("int").alias("total_meter_days"),
        "first_seen_session", "last_seen_session",
        F.coalesce(F.col("total_sessions"), F.lit(0)).cast("long").alias("total_sessions"),
        "latest_macaddr")


def _cfg_order() -> list[Column]:
    return [F.col("rev"), F.col("gamingday"), F.col("generated"), F.col("macaddr")]


def latest_cfg(cfg: DataFrame) -> DataFrame:
    """Latest configuration per position (E6, DISTINCT ON): highest ``rev``; the
    ties ``rev`` allows are broken by day, generated time and machine id."""
    c = cfg.filter(F.col("ipaddr").isNotNull())
    return latest_per_key(c, ["ipaddr"], _cfg_order())


def cfg_counts(cfg: DataFrame) -> DataFrame:
    """Configuration revisions and distinct machines per position."""
    c = cfg.filter(F.col("ipaddr").isNotNull())
    return c.groupBy("ipaddr").agg(F.count(F.lit(1)).alias("cfg_revisions"),
                                   F.countDistinct("macaddr").alias("machine_turnover"))


def all_positions(activity: DataFrame, cfg: DataFrame) -> DataFrame:
    """Distinct positions from the activity summary and the configuration (H2)."""
    return activity.select("ipaddr").union(cfg.filter(F.col("ipaddr").isNotNull()).select("ipaddr")).distinct()


CFG_FIELDS = ("inventorynr", "manufacturer", "model", "game", "serialnumber", "coindenom", "currency", "gametype",
              "licensenumber", "inuse")
BRIDGE_FIELDS = ("inventorynr", "manufacturer", "model", "game", "serialnumber", "coindenom")


def cfg_summary(cfg: DataFrame) -> DataFrame:
    """Latest configuration (E6) and the counts (D13) per position in one
    aggregation: one pass and one shuffle over the configuration table."""
    c = cfg.filter(F.col("ipaddr").isNotNull())
    latest = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(_cfg_order())],
                      F.struct(*[F.col(x) for x in CFG_FIELDS]).alias("_row"))
    g = c.groupBy("ipaddr").agg(F.max(latest).alias("_latest"), F.count(F.lit(1)).alias("cfg_revisions"),
                                F.countDistinct("macaddr").alias("machine_turnover"))
    return g.select("ipaddr", *[F.col(f"_latest._row.{x}").alias(x) for x in CFG_FIELDS], "cfg_revisions",
                    "machine_turnover")


def dim_position(activity: DataFrame, cfg: DataFrame, as_of: dt.date) -> DataFrame:
    """Position dimension (F9): all positions from activity and configuration,
    with the latest configuration, the counts and the status as of ``as_of``."""
    cs = cfg_summary(cfg)
    a = activity.select("ipaddr").union(cs.select("ipaddr")).distinct()
    c = cs.withColumnRenamed("ipaddr", "_cip")
    d = a.join(activity, "ipaddr", "left").join(c, F.col("ipaddr") == F.col("_cip"), "left")
    last_any = F.coalesce(F.col("last_seen_meter"), F.col("last_seen_session"))
    return d.select(
        "ipaddr", ip_readable("ipaddr").alias("ipaddr_readable"), floor_zone("ipaddr").alias("floor_zone"),
        position_in_zone("ipaddr").alias("position_in_zone"), "latest_macaddr", *[c for c in CFG_FIELDS if c != "inuse"],
        # the flag as configured; whether the position is active is read off its activity
        F.col("inuse").alias("cfg_in_use"),
        F.coalesce(last_any >= F.date_sub(_lit_date(as_of), 7), F.lit(False)).alias("is_active"),
        status_by_age(last_any, as_of, "Decommissioned", "Config Only").alias("position_status"),
        F.least("first_seen_meter", "first_seen_session").alias("first_seen"),
        F.greatest("last_seen_meter", "last_seen_session").alias("last_seen"),
        F.coalesce(F.col("total_meter_days"), F.lit(0)).cast("int").alias("total_meter_days"),
        F.coalesce(F.col("total_sessions"), F.lit(0)).cast("long").alias("total_sessions"),
        F.col("_cip").isNotNull().alias("has_egd_cfg"),
        F.coalesce(F.col("cfg_revisions"), F.lit(0)).cast("int").alias("cfg_revisions"),
        F.coalesce(F.col("machine_turnover"), F.lit(0)).cast("int").alias("machine_turnover"))


def machine_history(cfg: DataFrame, chunk_revs: int = 4096) -> DataFrame:
    """Machine-history bridge (F10, E8): per machine in revision order, the
    range runs from its day to the next revision's day (exclusive end; open end
    9999-12-31); the last revision of a machine is current.  Rows without a
    position are removed before the scan.

    LEAD is a reverse scan: the next row is the last row seen when walking the
    revisions backwards.  A machine's latest revision is the one with no next
    row, so one chunked scan gives both the range end and the current flag."""
    c = cfg.filter(F.col("ipaddr").isNotNull())
    c = c.withColumn("_next", F.struct(F.col("gamingday").alias("day")))
    # Forward order is (rev, gamingday, generated) ascending, NULLs last;
    # carry_last needs plain ascending columns, so the reverse order is
    # encoded by negating each key (a negated NULL still sorts first).
    c = c.withColumn("_o1", -F.col("rev")).withColumn("_o2", -F.datediff(F.col("gamingday"), F.lit("1970-01-01").cast("date"))) \
         .withColumn("_o3", -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                               F.col("generated")))
    # a NULL revision comes last, so first when walking backwards
    chunk = F.coalesce(-F.floor(F.col("rev") / F.lit(chunk_revs)), F.lit(-(2 ** 62)))
    s = carry_last(c, ["macaddr"], [F.col("_o1"), F.col("_o2"), F.col("_o3")], "_next", "_lead",
                   chunk=chunk, inclusive=False)
    is_latest = F.col("_lead").isNull()
    return s.select(
        "ipaddr", ip_readable("ipaddr").alias("ipaddr_readable"), "macaddr", "casinoid", "siteid",
        F.col("gamingday").alias("effective_from"),
        F.coalesce(F.col("_lead.day"), _lit_date(BRIDGE_OPEN_END)).alias("effective_to"),
        is_latest.alias("is_current"), *BRIDGE_FIELDS,
        F.when(is_latest & F.col("_lead.day").isNull(), "Current").otherwise("Historical").alias("assignment_status"),
        "rev")


def machine_periods(meter: DataFrame, as_of: dt.date) -> DataFrame:
    """Gaps and islands (E9, E10, F12): one row per (position, day) -- the latest
    generated; a new period starts at the first day, on a machine change, or
    after a gap of more than three days; min/max/count per period; status by
    the age of the period end."""
    m = plausible_meter(meter)
    daily = latest_per_key(m.select("ipaddr", "gamingday", "macaddr", "generated"), ["ipaddr", "gamingday"],
                           [F.col("generated").isNotNull(), F.col("generated"), F.col("macaddr")])
    chunk = F.date_trunc("month", F.col("gamingday"))
    daily = daily.withColumn("_cur", F.struct(F.col("macaddr").alias("mac"), F.col("gamingday").alias("day")))
    prev = carry_last(daily, ["ipaddr"], [F.col("gamingday")], "_cur", "_prev", chunk=chunk, inclusive=False)
    is_new = (F.col("_prev").isNull() | (F.col("macaddr") != F.col("_prev.mac"))
              | (F.datediff(F.col("gamingday"), F.col("_prev.day")) > NEW_PERIOD_GAP_DAYS))
    flagged = prev.withColumn("_new", is_new.cast("long")).drop("_cur", "_prev")
    grouped = running_sum(flagged, ["ipaddr"], [F.col("gamingday")], F.col("_new"), "_period", chunk=chunk)
    per = grouped.groupBy("ipaddr", "macaddr", "_period").agg(
        F.min("gamingday").alias("period_start"), F.max("gamingday").alias("period_end"),
        F.count(F.lit(1)).alias("days_active"))
    return per.select("ipaddr", ip_readable("ipaddr").alias("ipaddr_readable"), "macaddr", "period_start",
                      "period_end", "days_active",
                      status_by_age(F.col("period_end"), as_of, "Inactive", "Inactive").alias("period_status"))


def multi_machine_positions(periods: DataFrame) -> DataFrame:
    """Positions that hosted more than one machine (D16, HAVING)."""
    return (periods.groupBy("ipaddr_readable").agg(F.count(F.lit(1)).alias("periods"),
                                                   F.countDistinct("macaddr").alias("unique_machines"))
            .filter(F.col("unique_machines") > 1))


def status_breakdown(dim: DataFrame) -> DataFrame:
    """Positions per status."""
    return dim.groupBy("position_status").agg(F.count(F.lit(1)).alias("cnt"))


def position_checks(dim: DataFrame) -> DataFrame:
    """Orphan and active counts in one pass (K3/C12): positions without any
    configuration, and active positions."""
    return dim.agg(F.count_if(~F.col("has_egd_cfg")).alias("orphans"),
                   F.count_if(F.col("is_active")).alias("active"),
                   F.count(F.lit(1)).alias("positions"))
