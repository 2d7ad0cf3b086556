"""Named queries of stored tables: the writers and load procedures run on
storage, and the tables they leave are read back and compared row by row.

Every query writes its tables to a folder of its own below the shared
checkpoint folder, which is deleted when the driver ends.  Loads run twice:
a repeated run must leave the same table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import latest_per_key
from ..functions.predicates import month_bounds
from ..plans import loads, quality, silver
from ..sources import daypart, registry, sinks, swap
from ..sources.adapters import FROM_DAY, TO_DAY, bronze_for
from ..sources.tables import read_table
from . import entries_gold, entries_ingest, entries_positions, entries_silver  # noqa: F401  (their SQL is used here)
from .adapter_sql import with_adapters
from .check_sql import known
from .registry import ENTRIES, register, scratch

AGENT = 3


def _visit_states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return entries_ingest._visit_states(spark, sf)


@register("stored_upsert", "A7,A20", sql=ENTRIES["upsert_last_wins"].sql)
def q_stored_upsert(spark, sf):
    """The batch gives rows other agents, so they leave their agent's partition."""
    src = bronze_for(spark, sf).agents_players_src
    key, path = ["membership", "datechange"], scratch(spark)
    before = latest_per_key(src.filter(F.col("membership") % 3 != 0), key, [F.col("seq")]) \
        .withColumn("idagent", F.col("idagent") + 100)
    for batch in (before, *[src.filter(F.col("membership") % 4 != 0)] * 2):
        sinks.write_upsert(batch, path, key, F.col("seq"), ["idagent"])
    return swap.read_table(spark, path).select(*src.columns)


@register("stored_upsert_null_key", "A8", sql="""
SELECT DISTINCT ON (coalesce(k1, -1), coalesce(k2, -1), o_orderdate) k1, k2, o_orderdate, o_orderkey, o_totalprice
FROM (SELECT nullif(o_custkey % 7, 0) - CASE WHEN o_orderkey % 2 = 1 AND o_custkey % 7 = 1 THEN 2 ELSE 0 END AS k1,
             nullif(o_orderkey % 5, 0) AS k2, o_orderdate, o_orderkey, o_totalprice FROM orders)
ORDER BY coalesce(k1, -1), coalesce(k2, -1), o_orderdate, o_orderkey % 2 DESC, o_orderkey DESC""")
def q_stored_upsert_null_key(spark, sf):
    """Two runs with expression keys: the second one's -1 replaces the first one's NULL."""
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    minus_one = (F.col("o_orderkey") % 2 == 1) & (F.col("o_custkey") % 7 == 1)
    o = o.select((F.nullif(F.col("o_custkey") % 7, F.lit(0)) - F.when(minus_one, 2).otherwise(0)).alias("k1"),
                 F.nullif(F.col("o_orderkey") % 5, F.lit(0)).alias("k2"), "o_orderdate", "o_orderkey", "o_totalprice")
    path = scratch(spark)
    for odd in (0, 1):
        sinks.write_upsert(o.filter(F.col("o_orderkey") % 2 == odd), path,
                           ["coalesce(k1, -1)", "coalesce(k2, -1)", "o_orderdate"], F.col("o_orderkey"))
    return swap.read_table(spark, path)


@register("stored_range_refresh", "A17", sql=ENTRIES["range_refresh"].sql)
def q_stored_range_refresh(spark, sf):
    old, new = _visit_states(spark, sf)
    path = scratch(spark)
    sinks.write_full_refresh(old, path, ["gamingday"])
    for _ in range(2):
        sinks.write_range_refresh(new, path, "gamingday", FROM_DAY, TO_DAY, ["membership"])
    return swap.read_table(spark, path).select(*new.columns)


@register("stored_scoped_refresh", "A18", sql=ENTRIES["range_refresh_agent"].sql)
def q_stored_scoped_refresh(spark, sf):
    old, new = entries_ingest.agent_states(spark, sf)
    path = scratch(spark)
    sinks.write_full_refresh(old, path, ["gamingday"])
    for _ in range(2):
        sinks.write_scoped_refresh(new, path, "gamingday", FROM_DAY, TO_DAY, "idagent", AGENT,
                                   ["gamingday", "membership"])
    return swap.read_table(spark, path).select(*new.columns)


@register("stored_full_refresh", "A19", sql=ENTRIES["full_refresh"].sql)
def q_stored_full_refresh(spark, sf):
    """A day that only the old content has leaves its partition."""
    old, new = _visit_states(spark, sf)
    path = scratch(spark)
    for state in (old, new, new):
        sinks.write_full_refresh(state, path, ["gamingday"])
    return swap.read_table(spark, path).select(*new.columns)


@register("stored_purge", "A23", sql=with_adapters(["visits"], f"""
SELECT CASE WHEN datework < DATE '2024-01-10' THEN 'archived' ELSE 'kept' END AS place, *
FROM visits WHERE {known('membership')}"""))
def q_stored_purge(spark, sf):
    """Where every row ends: still in its table, or in the archive."""
    root = scratch(spark)
    visits = bronze_for(spark, sf).visits.filter(silver.known_member("membership"))
    sinks.write_full_refresh(visits, f"{root}/visits", ["datework"])
    for _ in range(2):
        sinks.archive_or_purge(spark, {"visits": (f"{root}/visits", F.col("datework"))}, entries_ingest.CUTOFF,
                               "archive_delete", f"{root}/archive")
    folder = f"{root}/archive/visits/cutoff={entries_ingest.CUTOFF.isoformat()}"
    places = {"kept": f"{root}/visits", "archived": folder}
    out = None
    for place, path in places.items():
        rows = swap.read_table(spark, path, visits.schema).select(F.lit(place).alias("place"), *visits.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------------------------------------- load procedures

@register("stored_membership_day", "P2,P8", sql=ENTRIES["membership_day"].sql)
def q_stored_membership_day(spark, sf):
    """The fact loaded for the whole range, then one agent's rows loaded again."""
    b, path = bronze_for(spark, sf), scratch(spark)
    loads.load_membership_day(b, FROM_DAY, TO_DAY, path)
    loads.load_membership_day(b, FROM_DAY, TO_DAY, path, agent_id=AGENT)
    return swap.read_table(spark, path)


def _marts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    root = scratch(spark)
    tables = {n: f"{root}/{n}" for n in ("fact_player_session", "fact_session_day_by_table_game",
                                         "fact_session_day_by_agent_group")}
    for _ in range(2):
        loads.load_session_marts(bronze_for(spark, sf), FROM_DAY, TO_DAY, tables)
    return swap.read_table(spark, tables[name])


@register("stored_player_session", "P6", sql=ENTRIES["player_session"].sql)
def q_stored_player_session(spark, sf):
    return _marts(spark, sf, "fact_player_session")


@register("stored_mart_agent_group", "P11,P14", sql=ENTRIES["mart_agent_group"].sql)
def q_stored_mart_agent_group(spark, sf):
    return _marts(spark, sf, "fact_session_day_by_agent_group")


@register("stored_machine_history", "P15", sql=ENTRIES["machine_history"].sql)
def q_stored_machine_history(spark, sf):
    root = scratch(spark)
    tables = {n: f"{root}/{n}" for n in ("dim_egd_position", "bridge_egd_machine_history")}
    for _ in range(2):
        loads.load_dim_position(bronze_for(spark, sf), entries_positions.AS_OF, tables)
    return swap.read_table(spark, tables["bridge_egd_machine_history"])


# --------------------------------------------------------------------------- days carried down

def day_tables(spark: SparkSession, sf: str) -> daypart.DayTables:
    """The detail tables stored by day, loaded in two runs: first every third
    child without its parent, then all the rest and all parents."""
    b, root = bronze_for(spark, sf), scratch(spark)
    tables = {link.table: f"{root}/{link.table}" for link in daypart.LINKS}
    heads = {link.parent: getattr(b, link.parent) for link in daypart.LINKS if link.parent not in tables}
    none = {name: rows.filter(F.lit(False)) for name, rows in heads.items()}
    first = {link.table: getattr(b, link.table).filter(F.col(link.up) % 3 == 0) for link in daypart.LINKS}
    rest = {link.table: getattr(b, link.table).filter(F.col(link.up) % 3 != 0) for link in daypart.LINKS}
    daypart.load_with_days(spark, first | none, none, tables)
    daypart.load_with_days(spark, rest | heads, heads, tables)
    return daypart.DayTables(spark, b, tables)


@register("stored_tracking_float", "C1,C10,D8", sql=ENTRIES["tracking_float"].sql)
def q_stored_tracking_float(spark, sf):
    return silver.tracking_day(day_tables(spark, sf), FROM_DAY, TO_DAY)


@register("stored_expense_day", "C3,D9", sql=ENTRIES["expense_day"].sql)
def q_stored_expense_day(spark, sf):
    return silver.expense_day(day_tables(spark, sf), FROM_DAY, TO_DAY)


# --------------------------------------------------------------------------- bronze sources

RUN_AT = dt.datetime(2024, 2, 1, 6)
# For the SQL: adapter, what its watermark reads, and its key as text.
_BRONZE_SQL = {
    "Person.Visits": ("visits", "created", None, "membership IS NOT NULL"),
    "Manage.Agents_Players": ("agents_players", "datechange", "(membership, datechange)", "membership IS NOT NULL"),
    "Manage.Agent_Groups": ("agent_groups", "modified", "idagentgroup", "true"),
    "Person.Players": ("players", "membership", "membership", "true"),
    "Casino.Games": ("games", None, "idgame", "true"),
    "Casino.Currency_ExchRates": ("fx_rates", "row_version", "(idcasino, datechange, idcurrency)", "true"),
    "CashDesk.view_Transactions": ("cashdesk_tx", "idoper", "idoper", "membership IS NOT NULL"),
    "Manage.PlayerSessions": ("player_sessions", "idplayerstracking", "(idplayerstracking, coalesce(timestart, DATE '1900-01-01'))",
                              "true"),
    "DRGT.Sessions": ("drgt", "id_session", "(playerid, id_session)", "playerid IS NOT NULL"),
    "Casino.Transaction_Money": ("tx_money", "idoper", "(idoper, idmoney)", "true"),
    "Promo.BonusIndicators_Games": ("indicator_games", None,
                                    "(coalesce(idgame, -1), coalesce(idslotmanufacturer, -1), datechange)", "true"),
}


def _bronze_sql() -> str:
    parts = []
    for name, (shape, watermark, key, kept) in _BRONZE_SQL.items():
        if watermark is None:
            value = f"'{RUN_AT.isoformat()}'"
        elif watermark in ("created", "datechange", "modified"):
            value = f"strftime(max({watermark}), '%Y-%m-%dT%H:%M:%S.%f')"
        else:
            value = f"CAST(max({watermark}) AS VARCHAR)"
        stored = "count(*)" if key is None else f"count(DISTINCT {key})"
        parts.append(f"SELECT '{name}' AS source_table, 'success' AS status, count(*) AS rows_read, {value} AS watermark_value, "
                     f"{stored} AS stored_rows FROM {shape} WHERE {kept}")
    return with_adapters([shape for shape, *_ in _BRONZE_SQL.values()], " UNION ALL ".join(parts))


@register("bronze_load", "A1,A2,A3,A5,A6,A7,A8,A9,A12,A13", sql=_bronze_sql())
def q_bronze_load(spark, sf):
    """Log, watermark and stored rows of a first load of configured sources."""
    root = scratch(spark)
    chosen = [s for s in registry.SOURCES if s.name in _BRONZE_SQL]
    registry.load_bronze(spark, bronze_for(spark, sf), root, RUN_AT, RUN_AT.date(), chosen)
    b = registry.StoredBronze(spark, root)
    sizes = quality.row_count_snapshot({s.name: getattr(b, s.shape) for s in chosen})
    log = spark.read.parquet(f"{root}/run_log").select("source_table", "status", "rows_read")
    marks = swap.read_table(spark, f"{root}/watermarks").select("source_table", "watermark_value")
    return (log.join(marks, "source_table")
            .join(sizes.select(F.col("table_name").alias("source_table"), F.col("rows").alias("stored_rows")), "source_table"))


@register("filter_month", "B1,2.8-11", sql=with_adapters(["visits"], """
SELECT datework, membership, created FROM visits
WHERE datework >= DATE '2024-01-01' AND datework <= last_day(make_date(2024, 1, 1))"""))
def q_filter_month(spark, sf):
    first, last = month_bounds(2024, 1)
    return bronze_for(spark, sf).visits.filter(F.col("datework").between(first, last)) \
        .select("datework", "membership", "created")
