"""Named queries of the gold layer: roll-up, marts, expense/bonus facts, visit report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import gold, silver
from ..sources import sinks, swap
from ..sources.adapters import FROM_DAY, TO_DAY, bronze_for
from . import check_sql as cs
from .adapter_sql import with_adapters
from .check_sql import DEC
from .entries_silver import MEMBERSHIP_DAY_SQL, PS_ADAPTERS
from .registry import register, scratch


def _b(spark, sf):
    return bronze_for(spark, sf)


def _sql_scale_down(int_expr: str, scale: int) -> str:
    return f"CAST({int_expr} AS DECIMAL(38,0)) * CAST({1 / 10 ** scale:.{scale}f} AS DECIMAL({scale + 1},{scale}))"


def sql_avg_exact(total: str, count: str, scale: int = 4) -> str:
    num = f"CAST(({total}) * {10 ** scale} AS HUGEINT)"
    q = f"sign({num}) * ((2 * abs({num}) + ({count})) // (2 * ({count})))"
    return f"CAST(CASE WHEN ({count}) > 0 THEN {_sql_scale_down(q, scale)} END AS DECIMAL({15 + scale},{scale}))"


# ---------------------------------------------------------------- period roll-up
PERIOD_SQL = "SELECT d.membership, max(surname) AS surname, max(forename) AS forename, max(idagent) AS idagent, " \
             "max(agentname) AS agentname, max(citizenshipcountry) AS citizenshipcountry, count(*) AS visitsdays, " + \
             ", ".join(f"CAST(sum({m}) AS {'BIGINT' if m.endswith('cnt') else DEC}) AS {m}" for m in silver.DAY_MEASURES) + \
             " FROM ({day}) d GROUP BY d.membership"


@register("membership_period", "D14,F2", sql=PERIOD_SQL.format(day=MEMBERSHIP_DAY_SQL))
def q_membership_period(spark, sf):
    return gold.membership_period(_b(spark, sf), FROM_DAY, TO_DAY)


@register("top_members", "G1", sql=f"""
SELECT membership, agentname, visitsdays, totaldrop_clean, totalcash_in
FROM ({PERIOD_SQL.format(day=MEMBERSHIP_DAY_SQL)}) p
ORDER BY totaldrop_clean DESC NULLS FIRST, membership ASC NULLS LAST LIMIT 20""")
def q_top_members(spark, sf):
    return gold.top_members(_b(spark, sf), FROM_DAY, TO_DAY, 20)


# ---------------------------------------------------------------- session marts
def _mart_sql(group_cols: str, extra: str = "") -> str:
    sums = ", ".join(f"CAST(coalesce(sum(coalesce({c}, 0)), 0) AS {DEC}) AS total_{c}" for c in gold.MART_SUMS)
    return with_adapters(PS_ADAPTERS, f"""
SELECT {group_cols}, {extra} count(*) AS sessionscnt, count(DISTINCT membership) AS memberscnt, {sums},
  {sql_avg_exact('sum(coalesce(averbet, 0))', 'count(*)')} AS avg_averbet
FROM ps GROUP BY ALL""", cs.PLAYER_SESSION)


@register("mart_table_game", "D10a,B15,F6", sql=_mart_sql(
    "gamingday, coalesce(idtable, -1) AS idtable, coalesce(idgame, -1) AS idgame"))
def q_mart_table_game(spark, sf):
    return gold.mart_table_game(_b(spark, sf), FROM_DAY, TO_DAY)


@register("mart_agent_group", "D10b,F6", sql=_mart_sql(
    "gamingday, coalesce(idagentgroup, -1) AS idagentgroup", "max(idagent) AS idagent,"))
def q_mart_agent_group(spark, sf):
    return gold.mart_agent_group(_b(spark, sf), FROM_DAY, TO_DAY)


# ---------------------------------------------------------------- expense fact
EXPENSE_ADAPTERS = ["cashdesk_tx", "tx_money", "players", "countries", "agents", "agents_players", "articles"]


@register("player_expenses", "F4,C5,B12", sql=with_adapters(EXPENSE_ADAPTERS, "SELECT * FROM e", cs.EXPENSE_FACT))
def q_player_expenses(spark, sf):
    return gold.player_expenses(_b(spark, sf), FROM_DAY, TO_DAY)


@register("classify_first_match", "B8,B10", sql=with_adapters(["cashdesk_tx"], """
SELECT idoper, idaccount, directionoper, comment, expense_type_key FROM cashdesk_tx JOIN keyed USING (idoper)
WHERE idaccount IN (641, 153, 151, 154)""", cs.EXPENSE_KEYS))
def q_classify_first_match(spark, sf):
    from ..functions.classify import expense_type_key
    c = _b(spark, sf).cashdesk_tx.filter(F.col("idaccount").isin(641, 153, 151, 154))
    return c.select("idoper", "idaccount", "directionoper", "comment",
                    expense_type_key(F.col("idaccount"), F.col("directionoper"), F.col("comment"))
                    .cast("int").alias("expense_type_key"))


@register("agent_label_txn", "B12", sql=with_adapters(EXPENSE_ADAPTERS, """
SELECT idoper, idagent, agentname FROM e""", cs.EXPENSE_FACT))
def q_agent_label_txn(spark, sf):
    return gold.player_expenses(_b(spark, sf), FROM_DAY, TO_DAY).select("idoper", "idagent", "agentname")


@register("expense_detail", "C13,A21", sql=with_adapters(EXPENSE_ADAPTERS, f"""
SELECT e.*, d.expense_group, d.expense_type FROM e JOIN {cs.EXPENSE_TYPES} ON d.expense_type_key = e.expense_type_key""",
                                                           cs.EXPENSE_FACT))
def q_expense_detail(spark, sf):
    return gold.expense_detail(_b(spark, sf), FROM_DAY, TO_DAY)


@register("fk_check", "C12,K3", sql=with_adapters(EXPENSE_ADAPTERS, f"""
SELECT count(*) AS fact_rows,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {cs.EXPENSE_TYPES} WHERE d.expense_type_key = e.expense_type_key))
         AS orphan_rows
FROM e""", cs.EXPENSE_FACT))
def q_fk_check(spark, sf):
    """The expense fact's reference to the expense-type dimension (the FK of the fact table)."""
    from ..operators.keys import reference_check
    e = gold.player_expenses(_b(spark, sf), FROM_DAY, TO_DAY)
    return reference_check(e, gold.dim_expense_type(spark), ["expense_type_key"])


# ---------------------------------------------------------------- bonus fact
BONUS_ADAPTERS = ["bonuses", "players", "countries", "agents", "agents_players", "games"]


@register("player_bonuses", "F5,C5,B12", sql=with_adapters(BONUS_ADAPTERS, "SELECT * FROM f", cs.BONUS_FACT))
def q_player_bonuses(spark, sf):
    return gold.player_bonuses(_b(spark, sf), FROM_DAY, TO_DAY)


@register("adt_product", "B19", sql=with_adapters(["bonuses"], f"""
SELECT idplayerbonus, CAST(multiplierloyalty * hours * handsperhour * averbet AS {DEC}) AS adt FROM bonuses"""))
def q_adt_product(spark, sf):
    from ..functions.decimals import adt_product
    return _b(spark, sf).bonuses.select(
        "idplayerbonus", adt_product("multiplierloyalty", "hours", "handsperhour", "averbet").alias("adt"))


# Every bonus entry as a booking: what it adds (earned) or takes back (reversed).
BOOKINGS = """
bookings AS (
  SELECT membership, gamingday - (CAST(extract(day FROM gamingday) AS INT) - 1) AS month, sumbonuses AS amount,
         typeoper > 0 AS earns, typeoper < 0 AS reverses, adt
  FROM f WHERE gamingday > DATE '2024-01-04')"""


@register("bonus_month", "D15", sql=with_adapters(BONUS_ADAPTERS, f"""
SELECT membership, month, count(*) AS bonus_entries,
  CAST(coalesce(sum(amount) FILTER (earns), 0) AS {DEC}) AS total_earned,
  CAST(coalesce(sum(amount) FILTER (reverses), 0) AS {DEC}) AS total_reversed, CAST(sum(amount) AS {DEC}) AS net_bonus,
  {sql_avg_exact('sum(adt) FILTER (earns)', 'count(adt) FILTER (earns)', 8)} AS avg_adt
FROM bookings GROUP BY membership, month""", cs.ctes(cs.BONUS_FACT, BOOKINGS)))
def q_bonus_month(spark, sf):
    import datetime as dt
    return gold.bonus_month(gold.player_bonuses(_b(spark, sf), FROM_DAY, TO_DAY), dt.date(2024, 1, 5))


@register("earned_bonuses", "B21", sql=with_adapters(BONUS_ADAPTERS, """
SELECT * EXCLUDE (idplayerbonus, timeoper, idagent, agentname, citizenshipcountry, idbonusindicator, idgame, costbonuses, isdeleted)
       RENAME (sumbonuses AS earned, multiplierloyalty AS house_edge_pct, adt AS average_daily_theoretical)
FROM f WHERE typeoper > 0""", cs.BONUS_FACT))
def q_earned_bonuses(spark, sf):
    return gold.earned_bonuses(gold.player_bonuses(_b(spark, sf), FROM_DAY, TO_DAY))


@register("dim_bonus_indicator", "A22", sql=with_adapters(["bonus_indicators"], """
SELECT DISTINCT ON (idbonusindicator) idbonusindicator, codebonusindicator, namebonusindicator
FROM bonus_indicators ORDER BY idbonusindicator, codebonusindicator DESC, namebonusindicator DESC"""))
def q_dim_bonus_indicator(spark, sf):
    return gold.dim_bonus_indicator(_b(spark, sf))


# ---------------------------------------------------------------- visit x session report
VISIT_ADAPTERS = ["visits", "player_sessions", "players_tracking"]


@register("visit_sessions", "F11,C7,E5", sql=with_adapters(VISIT_ADAPTERS, "SELECT * FROM report", cs.REPORT))
def q_visit_sessions(spark, sf):
    return gold.visit_sessions(_b(spark, sf), FROM_DAY, TO_DAY)


@register("overlap_join", "C7", sql=with_adapters(VISIT_ADAPTERS, """
SELECT gaming_day, membership, visit_no, idplayersession FROM met""", cs.REPORT))
def q_overlap_join(spark, sf):
    from ..operators.overlap import overlap_left_join_bucketed
    b = _b(spark, sf)
    v = gold.numbered_visits(b, FROM_DAY, TO_DAY)
    s = gold.game_sessions(b, FROM_DAY, TO_DAY)
    j = overlap_left_join_bucketed(v, s, ["gaming_day", "membership"], ["gaming_day", "membership", "visit_no"],
                                   "time_in", "time_out", "timestart", "timefinish")
    return j.select("gaming_day", "membership", "visit_no", "idplayersession")


@register("visit_no", "E5", sql=with_adapters(VISIT_ADAPTERS, "SELECT gaming_day, membership, visit_no, time_in, time_out FROM vb",
                                                cs.REPORT))
def q_visit_no(spark, sf):
    return gold.numbered_visits(_b(spark, sf), FROM_DAY, TO_DAY).select(
        "gaming_day", "membership", "visit_no", "time_in", "time_out")


@register("visit_report_extract", "A25", sql=with_adapters(VISIT_ADAPTERS, """
SELECT gaming_day AS GamingDay, membership AS Membership, visit_no AS VisitNo,
  substr(casino_entry_time, 1, 5) AS CasinoEntryTime, substr(casino_exit_time, 1, 5) AS CasinoExitTime,
  coalesce(substr(session_start, 1, 5), 'NULL') AS SessionStart, coalesce(substr(session_finish, 1, 5), 'NULL') AS SessionFinish,
  coalesce(CAST(averbet AS VARCHAR), 'NULL') AS averBet
FROM report""", cs.REPORT))
def q_visit_report_extract(spark, sf):
    return gold.visit_report_extract(gold.visit_sessions(_b(spark, sf), FROM_DAY, TO_DAY))


# ---------------------------------------------------------------- reconciliation
RECON_SQL = cs.REPORT + """,
norm AS (
  SELECT gaming_day, membership, visit_no,
    substr(CASE WHEN upper(trim(casino_entry_time)) = 'NULL' THEN NULL ELSE casino_entry_time END, 1, 8) AS casino_entry_time,
    substr(CASE WHEN upper(trim(casino_exit_time)) = 'NULL' THEN NULL ELSE casino_exit_time END, 1, 8) AS casino_exit_time,
    substr(CASE WHEN upper(trim(session_start)) = 'NULL' THEN NULL ELSE session_start END, 1, 8) AS session_start,
    substr(CASE WHEN upper(trim(session_finish)) = 'NULL' THEN NULL ELSE session_finish END, 1, 8) AS session_finish,
    CAST(round(averbet, 4) AS DECIMAL(19,4)) AS averbet
  FROM report),
legacy AS (SELECT * FROM norm),
generated AS (
  SELECT * FROM norm WHERE membership % 17 <> 0
  UNION ALL SELECT * FROM norm WHERE membership % 17 <> 0 AND membership % 19 = 0),
diff AS (
  SELECT 'only_in_legacy' AS side, *, count(*) AS n FROM (SELECT * FROM legacy EXCEPT ALL SELECT * FROM generated) GROUP BY ALL
  UNION ALL
  SELECT 'only_in_generated' AS side, *, count(*) AS n FROM (SELECT * FROM generated EXCEPT ALL SELECT * FROM legacy) GROUP BY ALL)"""


def _report(spark, sf):
    """The report as a stored table: both sides are read back, as files are compared."""
    path = scratch(spark)
    sinks.write_full_refresh(gold.visit_sessions(_b(spark, sf), FROM_DAY, TO_DAY), path)
    return swap.read_table(spark, path)


def _generated(report):
    """A generated version of a report: members divisible by 17 are missing, those divisible by 19 doubled."""
    m = F.col("membership")
    kept = report.filter(m % 17 != 0)
    return kept.unionByName(kept.filter(m % 19 == 0))


@register("reconcile_normalize", "H4", sql=with_adapters(VISIT_ADAPTERS, "SELECT * FROM norm", RECON_SQL))
def q_reconcile_normalize(spark, sf):
    return gold.normalize_report(gold.visit_sessions(_b(spark, sf), FROM_DAY, TO_DAY))


@register("reconcile_multiset", "H3,K4", sql=with_adapters(VISIT_ADAPTERS, "SELECT * FROM diff", RECON_SQL))
def q_reconcile_multiset(spark, sf):
    report = _report(spark, sf)
    return gold.reconcile(report, _generated(report))


@register("reconcile_top", "G3", sql=with_adapters(VISIT_ADAPTERS, """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY side ORDER BY n DESC, gaming_day ASC NULLS FIRST, membership ASC NULLS FIRST,
    visit_no ASC NULLS FIRST, casino_entry_time ASC NULLS FIRST, casino_exit_time ASC NULLS FIRST,
    session_start ASC NULLS FIRST, session_finish ASC NULLS FIRST, averbet ASC NULLS FIRST) AS rk FROM diff)
WHERE rk <= 15""", RECON_SQL))
def q_reconcile_top(spark, sf):
    report = _report(spark, sf)
    return gold.reconcile_top(gold.reconcile(report, _generated(report)), 15)


@register("reconcile_status", "K4", sql=with_adapters(VISIT_ADAPTERS, """
SELECT (SELECT count(*) FROM legacy) AS legacy_rows, (SELECT count(*) FROM generated) AS generated_rows,
  CAST(coalesce((SELECT sum(n) FROM diff WHERE side = 'only_in_legacy'), 0) AS BIGINT) AS only_in_legacy,
  CAST(coalesce((SELECT sum(n) FROM diff WHERE side = 'only_in_generated'), 0) AS BIGINT) AS only_in_generated,
  CASE WHEN coalesce((SELECT sum(n) FROM diff), 0) = 0 THEN 0 ELSE 1 END AS status""", RECON_SQL))
def q_reconcile_status(spark, sf):
    report = _report(spark, sf)
    return gold.reconcile_status(report, _generated(report))
