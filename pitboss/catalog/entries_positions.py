"""Named queries of the floor-position layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.dedupe import upsert_last_wins
from ..plans import positions as pos
from ..sources.adapters import bronze_for
from . import check_sql as cs
from .adapter_sql import with_adapters
from .registry import register

AS_OF = dt.date(2024, 1, 31)
AS_OF_LATE = dt.date(2024, 6, 1)


def _b(spark, sf):
    return bronze_for(spark, sf)


def _activity(b):
    return pos.egd_activity(b.meter_day, b.player_session_v7)


ACT_ADAPTERS = ["meter_day", "player_session_v7"]


@register("meter_activity", "D11,B18", sql=with_adapters(ACT_ADAPTERS, "SELECT * FROM meter", cs.ACTIVITY))
def q_meter_activity(spark, sf):
    return pos.meter_activity(_b(spark, sf).meter_day)


@register("session_activity", "D12", sql=with_adapters(ACT_ADAPTERS, "SELECT * FROM played_at", cs.ACTIVITY))
def q_session_activity(spark, sf):
    return pos.session_activity(_b(spark, sf).player_session_v7)


@register("latest_mac", "E7", sql=with_adapters(ACT_ADAPTERS, "SELECT * FROM lm", cs.ACTIVITY))
def q_latest_mac(spark, sf):
    return pos.latest_mac(_b(spark, sf).meter_day)


@register("full_outer", "C9", sql=with_adapters(ACT_ADAPTERS, """
SELECT ipaddr, first_seen_meter, last_seen_meter, if(metered, total_meter_days, NULL) AS total_meter_days,
       first_seen_session, last_seen_session, if(played, total_sessions, NULL) AS total_sessions
FROM per_position""", cs.ACTIVITY))
def q_full_outer(spark, sf):
    b = _b(spark, sf)
    return pos.meter_activity(b.meter_day).join(pos.session_activity(b.player_session_v7), "ipaddr", "full")


@register("egd_activity", "A16", sql=with_adapters(ACT_ADAPTERS, "SELECT * FROM activity", cs.ACTIVITY))
def q_egd_activity(spark, sf):
    return _activity(_b(spark, sf))


@register("latest_cfg", "E6", sql=with_adapters(["egd_cfg"], """
SELECT ipaddr, macaddr, rev, gamingday, inventorynr, manufacturer, model FROM lc""", cs.CONFIG))
def q_latest_cfg(spark, sf):
    return pos.latest_cfg(_b(spark, sf).egd_cfg).select(
        "ipaddr", "macaddr", "rev", "gamingday", "inventorynr", "manufacturer", "model")


@register("cfg_counts", "D13", sql=with_adapters(["egd_cfg"], "SELECT * FROM ccount", cs.CONFIG))
def q_cfg_counts(spark, sf):
    return pos.cfg_counts(_b(spark, sf).egd_cfg).select(
        "ipaddr", F.col("cfg_revisions").cast("int").alias("cfg_revisions"),
        F.col("machine_turnover").cast("int").alias("machine_turnover"))


@register("all_positions", "H2", sql=with_adapters(ACT_ADAPTERS + ["egd_cfg"], """
SELECT DISTINCT ipaddr FROM (SELECT ipaddr FROM seen UNION ALL SELECT ipaddr FROM egd_cfg WHERE ipaddr IS NOT NULL)""",
                                                  cs.ACTIVITY))
def q_all_positions(spark, sf):
    b = _b(spark, sf)
    return pos.all_positions(_activity(b), b.egd_cfg)


def _pos_sql(body: str, *as_of: tuple[str, str]) -> str:
    dims = [cs.positions(day, name) for day, name in as_of or (("2024-01-31", "dim"),)]
    return with_adapters(ACT_ADAPTERS + ["egd_cfg"], body, cs.ctes(cs.ACTIVITY, cs.CONFIG, *dims))


def _dim(spark, sf, as_of=AS_OF):
    b = _b(spark, sf)
    return pos.dim_position(_activity(b), b.egd_cfg, as_of)


@register("dim_position", "F9,H2,B17", sql=_pos_sql("SELECT * FROM dim"))
def q_dim_position(spark, sf):
    return _dim(spark, sf)


@register("ip_decode", "B16", sql=_pos_sql("SELECT ipaddr, ipaddr_readable, floor_zone, position_in_zone FROM dim"))
def q_ip_decode(spark, sf):
    return _dim(spark, sf).select("ipaddr", "ipaddr_readable", "floor_zone", "position_in_zone")


@register("status_by_age", "B17", sql=_pos_sql(
    """SELECT DATE '2024-01-31' AS as_of, ipaddr, last_seen, position_status FROM dim
UNION ALL SELECT DATE '2024-06-01', ipaddr, last_seen, position_status FROM dim_late""",
    ("2024-01-31", "dim"), ("2024-06-01", "dim_late")))
def q_status_by_age(spark, sf):
    out = None
    for as_of in (AS_OF, AS_OF_LATE):
        d = _dim(spark, sf, as_of).select(F.lit(as_of.isoformat()).cast("date").alias("as_of"), "ipaddr", "last_seen",
                                          "position_status")
        out = d if out is None else out.unionByName(d)
    return out


@register("status_breakdown", "D16", sql=_pos_sql("SELECT position_status, count(*) AS cnt FROM dim GROUP BY ALL"))
def q_status_breakdown(spark, sf):
    return pos.status_breakdown(_dim(spark, sf))


@register("active_positions", "B21", sql=_pos_sql("SELECT * FROM dim WHERE is_active"))
def q_active_positions(spark, sf):
    return _dim(spark, sf).filter(F.col("is_active"))


@register("orphan_check", "C12,K3", sql=_pos_sql("""
SELECT count(*) FILTER (WHERE NOT has_egd_cfg) AS orphans, count(*) FILTER (WHERE is_active) AS active,
       count(*) AS positions FROM dim"""))
def q_orphan_check(spark, sf):
    return pos.position_checks(_dim(spark, sf))


@register("machine_history", "F10,E8", sql=with_adapters(["egd_cfg"], "SELECT * FROM history", cs.HISTORY))
def q_machine_history(spark, sf):
    return pos.machine_history(_b(spark, sf).egd_cfg)


@register("machine_periods", "E9,E10,F12", sql=with_adapters(["meter_day"], "SELECT * FROM periods", cs.PERIODS))
def q_machine_periods(spark, sf):
    return pos.machine_periods(_b(spark, sf).meter_day, AS_OF)


@register("multi_machine_positions", "D16", sql=with_adapters(["meter_day"], """
SELECT ipaddr_readable, periods, unique_machines FROM (
  SELECT ipaddr_readable, count(*) AS periods, count(DISTINCT macaddr) AS unique_machines FROM periods GROUP BY ALL)
WHERE unique_machines > 1""", cs.PERIODS))
def q_multi_machine_positions(spark, sf):
    return pos.multi_machine_positions(pos.machine_periods(_b(spark, sf).meter_day, AS_OF))


@register("egd_cfg_upsert", "A15,A7", sql=with_adapters(["egd_cfg"], """
SELECT * FROM egd_cfg
UNION ALL SELECT * REPLACE (-rev AS rev, 'stored' AS inventorynr) FROM egd_cfg WHERE rev % 5 = 0"""))
def q_egd_cfg_upsert(spark, sf):
    """Config snapshot upserted (5-column key) over a target that holds the even
    revisions with other values, and revisions the snapshot does not have."""
    cfg = _b(spark, sf).egd_cfg
    stored = F.lit("stored").alias("inventorynr")
    others = [c for c in cfg.columns if c not in ("rev", "inventorynr")]
    target = (cfg.filter(F.col("rev") % 2 == 0).select(*others, "rev", stored)
              .unionByName(cfg.filter(F.col("rev") % 5 == 0).select(*others, (-F.col("rev")).alias("rev"), stored)))
    return upsert_last_wins(target.select(*cfg.columns), cfg, ["casinoid", "siteid", "macaddr", "smibip", "rev"],
                            F.col("generated"))
