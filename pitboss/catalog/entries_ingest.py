"""Named queries of ingest, table maintenance and run checks.

Each returns the resulting table state (or control rows) as a DataFrame, so
the same semantics can be checked against SQL without writing files; the
storage-side writers are exercised in the tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.asof import agent_at
from ..operators.dedupe import latest_per_key, upsert_last_wins
from ..plans import quality, silver
from ..sources import ingest, sinks
from ..sources.adapters import FROM_DAY, TO_DAY, bronze_for
from ..sources.tables import read_table
from .adapter_sql import with_adapters
from . import check_sql as cs
from .check_sql import DEC, RANGE, known
from .entries_silver import MEMBERSHIP_DAY_SQL, PS_ADAPTERS
from .registry import register


def _b(spark, sf):
    return bronze_for(spark, sf)


EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value")
RUN_DAY = dt.date(2024, 1, 23)          # run day of the re-read example: window starts 2024-01-20
CUSTOMER_CFG = ingest.SourceConfig("customer", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
                                   key=("c_custkey",))
NATION_CFG = ingest.SourceConfig("nation", ("n_nationkey", "n_name", "n_regionkey"), watermark_column="loaded",
                                 key=("n_nationkey",), full_snapshot=True)
BY_ID = ingest.SourceConfig("events_by_id", EVENT_COLS, "event_id", "int", key=("event_id",), member_column="user_id")
BY_TS = ingest.SourceConfig("events_by_ts", EVENT_COLS, "ts", "datetime", key=("event_id",), member_column="user_id")
BY_TYPE = ingest.SourceConfig("events_by_type", EVENT_COLS, "event_type", "text", key=("event_id",),
                              member_column="user_id")
CAUGHT_UP = ingest.SourceConfig("events_caught_up", EVENT_COLS, "event_id", "int", key=("event_id",),
                                member_column="user_id")
REREAD = ingest.SourceConfig("events_reread", EVENT_COLS, "event_id", "int", key=("event_id",),
                             lookback_column="ts", lookback_days=3, member_column="user_id")
# Fixed example watermarks, stored as text as in the control table.
WATERMARKS = {"events_by_id": "4000", "events_by_ts": "2024-01-15T00:00:00", "events_by_type": "purchase",
              "events_caught_up": "99999999", "events_reread": "8000"}
TYPED = (BY_ID, BY_TS, BY_TYPE, CAUGHT_UP)


def _events(spark, sf):
    return read_table(spark, sf, "events", *EVENT_COLS)


@register("src_project", "A1", sql="SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def q_src_project(spark, sf):
    return ingest.project(read_table(spark, sf, "customer"), CUSTOMER_CFG)


@register("src_full_snapshot", "A2,A7", sql="""SELECT n_nationkey, n_name, n_regionkey FROM nation
UNION ALL SELECT n_nationkey + 1000, 'stored', n_regionkey FROM nation WHERE n_nationkey = 3""")
def q_src_full_snapshot(spark, sf):
    """Snapshot loaded over a target with outdated rows and a row the source no longer has."""
    batch = ingest.extract(read_table(spark, sf, "nation"), NATION_CFG, None)
    stored = F.lit("stored").alias("n_name")
    target = (batch.filter(F.col("n_nationkey") % 2 == 0).select("n_nationkey", stored, "n_regionkey")
              .unionByName(batch.filter(F.col("n_nationkey") == 3)
                           .select((F.col("n_nationkey") + 1000).alias("n_nationkey"), stored, "n_regionkey")))
    return ingest.load(target, batch, NATION_CFG, F.lit(0))


@register("src_watermark", "A3,A5", sql="SELECT event_id, ts, user_id, event_type, value FROM events "
                                        "WHERE event_id > 4000 AND user_id IS NOT NULL")
def q_src_watermark(spark, sf):
    return ingest.extract(_events(spark, sf), BY_ID, WATERMARKS["events_by_id"])


@register("src_sliding_reread", "A4,A5", sql="""SELECT event_id, ts, user_id, event_type, value FROM events
WHERE (event_id > 8000 OR CAST(ts AS DATE) >= DATE '2024-01-20') AND user_id IS NOT NULL""")
def q_src_sliding_reread(spark, sf):
    return ingest.extract(_events(spark, sf), REREAD, WATERMARKS["events_reread"], today=RUN_DAY)


WM_FILTER_SQL = {
    "events_by_id": "event_id > 4000",
    "events_by_ts": "ts > TIMESTAMP '2024-01-15 00:00:00'",
    "events_by_type": "event_type > 'purchase'",
    "events_caught_up": "event_id > 99999999",
}
WM_TYPE = {"events_by_id": "int", "events_by_ts": "datetime", "events_by_type": "text", "events_caught_up": "int"}


@register("wm_typed_cast", "A11", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS source_table, '{WM_TYPE[n]}' AS watermark_type, count(*) AS rows_read FROM events "
    f"WHERE {w} AND user_id IS NOT NULL" for n, w in WM_FILTER_SQL.items()))
def q_wm_typed_cast(spark, sf):
    out = None
    for cfg in TYPED:
        ex = ingest.extract(_events(spark, sf), cfg, WATERMARKS[cfg.name])
        row = ex.agg(F.count(F.lit(1)).alias("rows_read")).select(
            F.lit(cfg.name).alias("source_table"), F.lit(cfg.watermark_type).alias("watermark_type"), "rows_read")
        out = row if out is None else out.unionByName(row)
    return out


WM_NEW_SQL = {
    "events_by_id": ("event_id", "CAST(coalesce(greatest(max(event_id), 4000), 4000) AS VARCHAR)"),
    "events_by_ts": ("ts", "strftime(coalesce(greatest(max(ts), TIMESTAMP '2024-01-15 00:00:00'), "
                           "TIMESTAMP '2024-01-15 00:00:00'), '%Y-%m-%dT%H:%M:%S.%f')"),
    "events_by_type": ("event_type", "coalesce(greatest(max(event_type), 'purchase'), 'purchase')"),
    "events_caught_up": ("event_id", "CAST(coalesce(greatest(max(event_id), 99999999), 99999999) AS VARCHAR)"),
}


@register("wm_advance", "A6,A12", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS source_table, '{c}' AS watermark_column, {v} AS watermark_value FROM events "
    f"WHERE {WM_FILTER_SQL[n]} AND user_id IS NOT NULL" for n, (c, v) in WM_NEW_SQL.items()))
def q_wm_advance(spark, sf):
    out = None
    for cfg in TYPED:
        ex = ingest.extract(_events(spark, sf), cfg, WATERMARKS[cfg.name])
        row = ingest.advance_watermark(ex, cfg, WATERMARKS[cfg.name])
        out = row if out is None else out.unionByName(row)
    return out


@register("run_log", "A13", sql=" UNION ALL ".join(
    f"SELECT 'bronze_incremental' AS pipeline_name, '{n}' AS source_table, 'success' AS status, "
    f"count(*) AS rows_read, count(DISTINCT event_id) AS rows_written, CAST(NULL AS VARCHAR) AS error_message "
    f"FROM events WHERE {w} AND user_id IS NOT NULL" for n, w in WM_FILTER_SQL.items()))
def q_run_log(spark, sf):
    out = None
    for cfg in TYPED:
        ex = ingest.extract(_events(spark, sf), cfg, WATERMARKS[cfg.name])
        # rows_written: rows left after the keyed last-wins reduction of the batch
        counts = ex.agg(F.count(F.lit(1)).alias("rows_read"), F.count_distinct(*cfg.key).alias("rows_written"))
        row = ingest.run_log_rows(spark, "bronze_incremental", counts.select(F.lit(cfg.name).alias("source_table"),
                                                                             "rows_read", "rows_written"))
        out = row if out is None else out.unionByName(row)
    return out


@register("seed_if_absent", "A12", sql="""SELECT * FROM region WHERE r_regionkey < 3
UNION ALL SELECT * FROM region s WHERE NOT EXISTS (SELECT 1 FROM region t WHERE t.r_regionkey = s.r_regionkey
                                                   AND t.r_regionkey < 3)""")
def q_seed_if_absent(spark, sf):
    region = read_table(spark, sf, "region")
    return ingest.seed_if_absent(region.filter(F.col("r_regionkey") < 3), region, ["r_regionkey"])


@register("upsert_last_wins", "A7", sql=with_adapters(["agents_players_src"], """
SELECT * FROM fresh UNION ALL SELECT * FROM stored ANTI JOIN fresh USING (membership, datechange)""", """
stored AS (
  SELECT DISTINCT ON (membership, datechange) membership, idagent + 100 AS idagent, datechange, created, seq
  FROM agents_players_src WHERE membership % 3 <> 0 ORDER BY membership, datechange, seq DESC),
fresh AS (
  SELECT DISTINCT ON (membership, datechange) membership, idagent, datechange, created, seq
  FROM agents_players_src WHERE membership % 4 <> 0 ORDER BY membership, datechange, seq DESC)"""))
def q_upsert_last_wins(spark, sf):
    """Some keys only stored, some only in the batch, some in both with another value."""
    src = _b(spark, sf).agents_players_src
    key = ["membership", "datechange"]
    target = latest_per_key(src.filter(F.col("membership") % 3 != 0), key, [F.col("seq")]) \
        .withColumn("idagent", F.col("idagent") + 100)
    return upsert_last_wins(target, src.filter(F.col("membership") % 4 != 0), key, F.col("seq"))


@register("upsert_null_key", "A8", sql="""
SELECT DISTINCT ON (coalesce(k1, -1), coalesce(k2, -1), o_orderdate) k1, k2, o_orderdate, o_orderkey, o_totalprice
FROM (SELECT nullif(o_custkey % 7, 0) AS k1, nullif(o_orderkey % 5, 0) AS k2, o_orderdate, o_orderkey, o_totalprice
      FROM orders)
ORDER BY coalesce(k1, -1), coalesce(k2, -1), o_orderdate, o_orderkey DESC""")
def q_upsert_null_key(spark, sf):
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    o = o.select(F.nullif(F.col("o_custkey") % 7, F.lit(0)).alias("k1"),
                 F.nullif(F.col("o_orderkey") % 5, F.lit(0)).alias("k2"), "o_orderdate", "o_orderkey", "o_totalprice")
    key = [F.coalesce(F.col("k1"), F.lit(-1)), F.coalesce(F.col("k2"), F.lit(-1)), F.col("o_orderdate")]
    return ingest.dedupe_batch(o, key, F.col("o_orderkey"))


@register("append_only", "A9", sql=with_adapters(["visits"], """
SELECT * FROM visits WHERE datework < DATE '2024-01-15'
UNION ALL SELECT * FROM visits WHERE datework >= DATE '2024-01-12'"""))
def q_append_only(spark, sf):
    """Rows that are stored already are appended again: this load has no key."""
    v = _b(spark, sf).visits
    cfg = ingest.SourceConfig("visits", tuple(v.columns), "created", "datetime")
    day = F.col("datework")
    return ingest.load(v.filter(day < F.lit("2024-01-15").cast("date")), v.filter(day >= F.lit("2024-01-12").cast("date")),
                       cfg, F.lit(0))


@register("coerce_bool", "A10", sql="""
SELECT doc_id, CAST(quality AS BOOLEAN) AS quality, CAST(toxic AS BOOLEAN) AS toxic FROM labels""")
def q_coerce_bool(spark, sf):
    cfg = ingest.SourceConfig("labels", ("doc_id", "quality", "toxic"), bool_columns=("quality", "toxic"))
    return ingest.project(read_table(spark, sf, "labels"), cfg)


VISITS_EVOLVED = T.StructType([
    T.StructField("datework", T.DateType()), T.StructField("membership", T.LongType()),
    T.StructField("time_in", T.TimestampNTZType()), T.StructField("time_out", T.TimestampNTZType()),
    T.StructField("created", T.TimestampNTZType()), T.StructField("minutes_played", T.DecimalType(19, 4)),
])


@register("schema_conform", "A24", sql=with_adapters(["visits"], f"""
SELECT datework, membership, time_in, time_out, created, CAST(0 AS {DEC}) AS minutes_played FROM visits"""))
def q_schema_conform(spark, sf):
    return sinks.conform(_b(spark, sf).visits, VISITS_EVOLVED, {"minutes_played": 0})


GROUP_SQL = """
SELECT g.idagentgroup, g.idagent, a.nameagent, g.nameagentgroup, g.datebegin, g.dateend, g.memoagentgroup, g.row_version,
       g.modified
FROM agent_groups g LEFT JOIN agents a ON a.idagent = g.idagent"""


@register("dim_upsert", "A20,F8", sql=with_adapters(["agent_groups", "agents"], GROUP_SQL + """
UNION ALL SELECT -idagentgroup - 1, idagent, 'stored', nameagentgroup, datebegin, dateend, memoagentgroup, row_version, modified
FROM agent_groups WHERE idagentgroup % 5 = 0"""))
def q_dim_upsert(spark, sf):
    """Source rows over a stored dimension with outdated names and rows without a source."""
    b = _b(spark, sf)
    rows = silver.reference_dim(b, "dim_agent_group_scd")
    old = rows.withColumn("nameagent", F.lit("stored"))
    stored = old.filter(F.col("idagentgroup") % 2 == 0).unionByName(
        old.filter(F.col("idagentgroup") % 5 == 0).withColumn("idagentgroup", -F.col("idagentgroup") - 1))
    return silver.load_reference_dims(b, {"dim_agent_group_scd": stored})["dim_agent_group_scd"]


def _register_dim(name: str, shape: str, outdated: str) -> None:
    """One row per dimension: full columns, over a target that holds outdated
    rows of some keys and one row the source does not have."""
    _, key, cols = silver.REFERENCE_DIMS[name]
    extra = ", ".join(f"{c} + 1000 AS {c}" if c == key[0] else ("'stored'" if c == outdated else c) + f" AS {c}" for c in cols)
    sql = with_adapters([shape], f"SELECT {', '.join(cols)} FROM {shape} UNION ALL SELECT {extra} FROM {shape} WHERE {key[0]} = 1")

    @register(name, "A20,F8", sql=sql)
    def builder(spark, sf):
        b = _b(spark, sf)
        rows = silver.reference_dim(b, name)
        old = rows.withColumn(outdated, F.lit("stored")) if outdated else rows
        stored = old.filter(F.col(key[0]) % 2 == 0).unionByName(
            old.filter(F.col(key[0]) == 1).withColumn(key[0], F.col(key[0]) + 1000))
        return silver.load_reference_dims(b, {name: stored})[name]


for _name, _shape, _outdated in (("dim_game", "games", "namegame"), ("dim_table_type", "table_types", "nametabletype"),
                                 ("bridge_table_type_game", "table_type_games", ""), ("dim_table", "tables_ref", "nametable")):
    _register_dim(_name, _shape, _outdated)


@register("load_reference_dims", "A20,F8", sql=with_adapters(
    ["games", "table_types", "table_type_games", "tables_ref", "agent_groups"], """
SELECT 'dim_game' AS dimension, count(*) AS rows, CAST(sum(idgame) AS BIGINT) AS ids FROM games
UNION ALL SELECT 'dim_table_type', count(*), CAST(sum(idtabletype) AS BIGINT) FROM table_types
UNION ALL SELECT 'bridge_table_type_game', count(*), CAST(sum(idgame) AS BIGINT) FROM table_type_games
UNION ALL SELECT 'dim_table', count(*), CAST(sum(idtable) AS BIGINT) FROM tables_ref
UNION ALL SELECT 'dim_agent_group_scd', count(*), CAST(sum(idagentgroup) AS BIGINT) FROM agent_groups"""))
def q_load_reference_dims(spark, sf):
    """All five dimensions of one load, summed up; their rows are compared one by one above."""
    out = None
    for name, df in silver.load_reference_dims(_b(spark, sf)).items():
        ids = silver.REFERENCE_DIMS[name][1][-1]
        row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(ids).cast("long").alias("ids")) \
            .select(F.lit(name).alias("dimension"), "rows", "ids")
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- refresh states
REMOVED_DAY = "2024-01-10"     # the day whose source rows are gone in the recomputation


def visit_day_aggregate(visits):
    return visits.filter(silver.known_member("membership")).groupBy(
        F.col("datework").alias("gamingday"), "membership").agg(
        F.count(F.lit(1)).alias("visits"), F.min(F.coalesce("time_in", "created")).alias("first_in"))


SQL_VISIT_DAY = f"""
old_state AS (
  SELECT datework AS gamingday, membership, count(*) AS visits, min(coalesce(time_in, created)) AS first_in
  FROM visits WHERE {known('membership')} GROUP BY ALL),
new_state AS (
  SELECT datework AS gamingday, membership, count(*) AS visits, min(coalesce(time_in, created)) AS first_in
  FROM visits WHERE {known('membership')} AND datework <> DATE '{REMOVED_DAY}' GROUP BY ALL)"""


def _visit_states(spark, sf):
    v = _b(spark, sf).visits
    return visit_day_aggregate(v), visit_day_aggregate(v.filter(F.col("datework") != F.lit(REMOVED_DAY).cast("date")))


@register("range_refresh", "A17", sql=with_adapters(["visits"], f"""
SELECT * FROM old_state WHERE NOT (gamingday {RANGE}) OR gamingday IS NULL
UNION ALL SELECT * FROM new_state WHERE gamingday {RANGE}""", SQL_VISIT_DAY))
def q_range_refresh(spark, sf):
    old, new = _visit_states(spark, sf)
    return sinks.refresh_range_state(old, new, "gamingday", FROM_DAY, TO_DAY)


@register("full_refresh", "A19", sql=with_adapters(["visits"], "SELECT * FROM new_state", SQL_VISIT_DAY))
def q_full_refresh(spark, sf):
    return sinks.full_refresh_state(_visit_states(spark, sf)[1])


SQL_AGENT_STATES = SQL_VISIT_DAY + f""",
old_agent AS (SELECT o.*, CAST(nullif(pl.idagent, 0) AS INT) AS idagent FROM old_state o
              LEFT JOIN players pl ON pl.membership = o.membership),""" + cs.agent_at("new_at", "new_state", "first_in") + f""",
new_agent AS (SELECT * EXCLUDE (agent_at), CAST(agent_at AS INT) AS idagent FROM new_at),
new_scoped AS (SELECT * FROM new_agent WHERE gamingday {RANGE} AND idagent = 3)"""


@register("range_refresh_agent", "A18", sql=with_adapters(["visits", "players", "agents_players"], """
SELECT * FROM old_agent o
WHERE NOT coalesce(o.gamingday BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND o.idagent = 3, false)
  AND NOT EXISTS (SELECT 1 FROM new_scoped n WHERE n.gamingday = o.gamingday AND n.membership = o.membership)
UNION ALL SELECT * FROM new_scoped""", SQL_AGENT_STATES))
def q_range_refresh_agent(spark, sf):
    old_a, new_a = agent_states(spark, sf)
    return sinks.refresh_scoped_state(old_a, new_a, "gamingday", FROM_DAY, TO_DAY, "idagent", 3,
                                      ["gamingday", "membership"])


def agent_states(spark, sf):
    """Day aggregates with the player's agent (old) and with the agent of that day (new)."""
    b = _b(spark, sf)
    old, new = _visit_states(spark, sf)
    pl = b.players.select(F.col("membership").alias("_pm"), F.nullif(F.col("idagent"), F.lit(0)).alias("idagent"))
    old_a = old.join(pl, old["membership"] == pl["_pm"], "left").drop("_pm") \
        .withColumn("idagent", F.col("idagent").cast("int"))
    new_a = agent_at(new, b.agents_players, b.players.select("membership", "idagent"), "membership", "first_in") \
        .withColumn("idagent", F.col("idagent").cast("int"))
    return old_a, new_a


# ---------------------------------------------------------------- archive / purge
CUTOFF = dt.date(2024, 1, 10)
PURGE_TABLES_SQL = {
    "bronze.person_visits_raw": ("visits", "datework"),
    "bronze.cashdesk_transactions_raw": ("cashdesk_tx", "datework"),
    "bronze.casino_players_tracking_raw": ("players_tracking", "datework"),
    "bronze.manage_player_sessions_raw": ("player_sessions", "CAST(timestart AS DATE)"),
}


def _purge_sql() -> str:
    parts = []
    for mode in sinks.ARCHIVE_MODES:
        for name, (tbl, day) in PURGE_TABLES_SQL.items():
            archived = "count(*) FILTER (WHERE {d} < DATE '2024-01-10')".format(d=day) if mode == "archive_delete" \
                else "CAST(0 AS BIGINT)"
            parts.append(f"SELECT '{mode}' AS mode, '{name}' AS table_name, {archived} AS archived_rows, "
                         f"count(*) FILTER (WHERE {day} < DATE '2024-01-10') AS deleted_rows FROM {tbl}")
    return with_adapters(["visits", "cashdesk_tx", "players_tracking", "player_sessions"], " UNION ALL ".join(parts))


@register("archive_purge", "A23", sql=_purge_sql())
def q_archive_purge(spark, sf):
    b = _b(spark, sf)
    tables = {
        "bronze.person_visits_raw": (b.visits, F.col("datework")),
        "bronze.cashdesk_transactions_raw": (b.cashdesk_tx, F.col("datework")),
        "bronze.casino_players_tracking_raw": (b.players_tracking, F.col("datework")),
        "bronze.manage_player_sessions_raw": (b.player_sessions, F.to_date("timestart")),
    }
    out = None
    for mode in sinks.ARCHIVE_MODES:
        c = sinks.archive_purge_counts(tables, CUTOFF, mode).select(F.lit(mode).alias("mode"), "*")
        out = c if out is None else out.unionByName(c)
    return out


# ---------------------------------------------------------------- run window and checks
LAST_LOADED = "2024-01-17"
YESTERDAY = dt.date(2024, 1, 20)


@register("refresh_window", "K1,D18", sql=f"""
WITH d AS ({MEMBERSHIP_DAY_SQL}),
t AS (SELECT max(gamingday) AS last_loaded_day FROM d WHERE gamingday <= DATE '{LAST_LOADED}')
SELECT last_loaded_day,
  CASE WHEN last_loaded_day IS NOT NULL AND last_loaded_day < DATE '2024-01-20' THEN last_loaded_day
       ELSE DATE '2024-01-20' END AS from_day,
  DATE '2024-01-20' AS to_day,
  CASE WHEN last_loaded_day IS NOT NULL AND last_loaded_day < DATE '2024-01-20' THEN 'catchup' ELSE 'daily' END AS mode
FROM t
UNION ALL SELECT last_loaded_day, DATE '2024-01-17', DATE '2024-01-20', 'lookback' FROM t""")
def q_refresh_window(spark, sf):
    d = silver.membership_day(_b(spark, sf), FROM_DAY, TO_DAY)
    loaded = d.filter(F.col("gamingday") <= F.lit(LAST_LOADED).cast("date"))
    a = quality.refresh_window(loaded, "gamingday", YESTERDAY)
    b = quality.refresh_window(loaded, "gamingday", YESTERDAY, lookback_days=3, anchor=YESTERDAY)
    return a.unionByName(b)


@register("health_check", "K2", sql=f"""
WITH d AS ({MEMBERSHIP_DAY_SQL})
SELECT DATE '2024-01-20' AS day, count(*) FILTER (WHERE gamingday = DATE '2024-01-20') > 0 AS has_rows FROM d
UNION ALL SELECT DATE '2024-01-21', count(*) FILTER (WHERE gamingday = DATE '2024-01-21') > 0 FROM d""")
def q_health_check(spark, sf):
    d = silver.membership_day(_b(spark, sf), FROM_DAY, TO_DAY)
    return quality.health_check(d, "gamingday", YESTERDAY).unionByName(
        quality.health_check(d, "gamingday", YESTERDAY + dt.timedelta(days=1)))


def _snapshot_sql() -> str:
    from .entries_positions import ACT_ADAPTERS
    extra = cs.ctes("md AS (" + MEMBERSHIP_DAY_SQL + ")", cs.ACTIVITY, cs.CONFIG, cs.positions("2024-01-31"))
    return with_adapters(["cashdesk_tx", "drgt", "tx_money", "egd_cfg"] + ACT_ADAPTERS, """
SELECT 'bronze.cashdesk_transactions_raw' AS table_name, count(*) AS rows FROM cashdesk_tx
UNION ALL SELECT 'bronze.drgt_sessions_raw', count(*) FROM drgt
UNION ALL SELECT 'bronze.casino_transaction_money_raw', count(*) FROM tx_money
UNION ALL SELECT 'silver.fact_membership_day', count(*) FROM md
UNION ALL SELECT 'gold.fact_membership_day', count(*) FROM md
UNION ALL SELECT 'gold.dim_egd_position', count(*) FROM dim
UNION ALL SELECT 'gold.dim_egd_position.active', count(*) FROM dim WHERE is_active""", extra)


@register("row_count_snapshot", "D17", sql=_snapshot_sql())
def q_row_count_snapshot(spark, sf):
    """The run snapshot: three whole bronze tables, the member-day fact of the
    range (silver and gold are one table here), all and active positions."""
    from ..plans import positions as pos
    from .entries_positions import AS_OF
    b = _b(spark, sf)
    md = silver.membership_day(b, FROM_DAY, TO_DAY)
    dim = pos.dim_position(pos.egd_activity(b.meter_day, b.player_session_v7), b.egd_cfg, AS_OF)
    return quality.row_count_snapshot({
        "bronze.cashdesk_transactions_raw": b.cashdesk_tx,
        "bronze.drgt_sessions_raw": b.drgt_sessions,
        "bronze.casino_transaction_money_raw": b.tx_money,
        ("silver.fact_membership_day", "gold.fact_membership_day"): md,
        ("gold.dim_egd_position", "gold.dim_egd_position.active"): (dim, [None, F.col("is_active")]),
    })
