"""Gold layer: period roll-up, session marts, expense and bonus facts, visit report.

All functions build lazy plans over ``Bronze`` inputs (see ``plans.silver``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import EXPENSE_ACCOUNTS, EXPENSE_TYPES, agent_label_loose, expense_type_key
from ..functions.decimals import adt_product, avg_half_up
from ..functions.predicates import day_between, known_member, not_deleted, unknown_key
from ..operators.asof import agent_at
from ..operators.overlap import overlap_left_join_bucketed
from ..operators.reconcile import difference_totals, multiset_difference
from ..operators.pool import hour_chunk
from ..operators.scan import balanced_chunks, chunked_row_number, nulls_last
from . import silver

DEC = "decimal(19,4)"


# --------------------------------------------------------------------------- period roll-up

def membership_period(b, f, t, agent_id: int | None = None, day_fact: DataFrame | None = None) -> DataFrame:
    """Member roll-up over a day range (D14/F2): five independent label maxima,
    day count and 34 sums.  ``day_fact`` is the stored member-day fact; when
    absent it is computed for the range."""
    d = day_fact if day_fact is not None else silver.membership_day(b, f, t)
    d = d.filter(day_between("gamingday", f, t))
    if agent_id is not None:
        d = d.filter(F.col("idagent") == F.lit(agent_id))
    labels = [F.max(c).alias(c) for c in ("surname", "forename", "idagent", "agentname", "citizenshipcountry")]
    sums = [F.sum(m).cast("long" if m.endswith("cnt") else DEC).alias(m) for m in silver.DAY_MEASURES]
    return d.groupBy("membership").agg(*labels, F.count(F.lit(1)).alias("visitsdays"), *sums)


def top_members(b, f, t, n: int = 20) -> DataFrame:
    """Top-n members of the period by clean drop (G1): ``ORDER BY totaldrop_clean
    DESC NULLS FIRST, membership`` -- the limit is the report itself."""
    p = membership_period(b, f, t)
    return (p.orderBy(F.col("totaldrop_clean").desc_nulls_first(), F.col("membership").asc_nulls_last())
            .limit(n).select("membership", "agentname", "visitsdays", "totaldrop_clean", "totalcash_in"))


# --------------------------------------------------------------------------- session marts

MART_SUMS = ("realdrop", "handhold", "cashout", "chipsin", "chipsout")


def _mart_measures() -> list[Column]:
    z = F.lit(0).cast(DEC)
    return [F.count(F.lit(1)).alias("sessionscnt"),
            F.countDistinct("membership").alias("memberscnt"),
            *[F.coalesce(F.sum(F.coalesce(F.col(c), z)), z).cast(DEC).alias(f"total_{c}") for c in MART_SUMS],
            avg_half_up(F.sum(F.coalesce(F.col("averbet"), z)), F.count(F.lit(1))).alias("avg_averbet")]


def mart_table_game(b, f, t, sessions: DataFrame | None = None) -> DataFrame:
    """Sessions by (day, table, game) (D10a); unknown table/game become -1."""
    s = sessions if sessions is not None else silver.player_session(b, f, t)
    s = s.filter(day_between("gamingday", f, t))
    return s.groupBy("gamingday", unknown_key("idtable").alias("idtable"),
                     unknown_key("idgame").alias("idgame")).agg(*_mart_measures())


def mart_agent_group(b, f, t, sessions: DataFrame | None = None) -> DataFrame:
    """Sessions by (day, agent group) plus the highest agent id."""
    s = sessions if sessions is not None else silver.player_session(b, f, t)
    s = s.filter(day_between("gamingday", f, t))
    return s.groupBy("gamingday", unknown_key("idagentgroup").alias("idagentgroup")).agg(
        F.max("idagent").alias("idagent"), *_mart_measures())


# --------------------------------------------------------------------------- expense fact

def dim_expense_type(spark) -> DataFrame:
    """The eight-row expense-type dimension (A21); a fixed seed."""
    schema = ("expense_type_key int, account_id int, direction int, expense_group string, "
              "expense_type string, sort_order int")
    return spark.createDataFrame(list(EXPENSE_TYPES), schema)


def _member_dims(b, df: DataFrame, time_col: str, counted: DataFrame) -> DataFrame:
    """As-of agent at ``time_col`` (split by hour for hot members; ``counted`` finds
    the hours that are busy themselves), loose label, country."""
    players = b.players.select("membership", "idagent", "idcountry")
    # Transaction probes: a member may hold a large share of one day's rows,
    # so the split scan chunks by hour.
    d = agent_at(df, b.agents_players, players, "membership", time_col, split_by_day=True,
                 player_cols=("idcountry",), chunk_unit="hour", counted=counted)
    ag = b.agents.select(F.col("idagent").alias("_aid"), "nameagent")
    cc = b.countries.select(F.col("idcountry").alias("_cid"), "namecountry")
    d = d.join(ag, F.col("idagent") == F.col("_aid"), "left").join(cc, F.col("idcountry") == F.col("_cid"), "left")
    return d.withColumn("agentname", agent_label_loose(F.col("idagent"), F.col("nameagent"))) \
        .withColumn("citizenshipcountry", F.col("namecountry")) \
        .drop("_aid", "_cid", "nameagent", "namecountry", "idcountry")


def expense_rows(b, f, t) -> DataFrame:
    c = silver.cashdesk_in_range(b, f, t).filter(F.col("idaccount").isin(*EXPENSE_ACCOUNTS))
    c = c.join(silver.money_per_oper(b, c, (f, t)), "idoper", "left")
    return c.withColumn("expense_type_key",
                        expense_type_key(F.col("idaccount"), F.col("directionoper"), F.col("comment")))


def player_expenses(b, f, t) -> DataFrame:
    """Expense transaction fact (F4) with the first-match key (B8) and the
    as-of agent at the operation time (C5)."""
    c = expense_rows(b, f, t).filter(F.col("expense_type_key").isNotNull())
    d = _member_dims(b, c, "timeoper", silver.cashdesk_in_range(b, f, t).filter(
        F.col("idaccount").isin(*EXPENSE_ACCOUNTS)))
    ar = b.articles.select(F.col("idarticle").alias("_arid"), F.col("namearticle").alias("article_name"))
    d = d.join(ar, F.col("idarticle") == F.col("_arid"), "left")
    return d.select("idoper", F.col("expense_type_key").cast("int").alias("expense_type_key"),
                    F.col("datework").alias("gamingday"), "membership",
                    F.col("idagent").cast("int").alias("idagent"), "agentname", "citizenshipcountry",
                    F.coalesce(F.col("summoney"), F.lit(0)).cast(DEC).alias("amount"), "comment", "idarticle",
                    "article_name")


def expense_rejects(b, f, t) -> DataFrame:
    """Rows no expense rule fits (agent credit with another direction); kept apart
    instead of failing the load."""
    return expense_rows(b, f, t).filter(F.col("expense_type_key").isNull())


def expense_detail(b, f, t) -> DataFrame:
    """Consumer join of the expense fact with its dimension."""
    e = player_expenses(b, f, t)
    d = dim_expense_type(e.sparkSession).select("expense_type_key", "expense_group", "expense_type")
    # Eight rows, a fixed seed: broadcasting it is bounded by construction.
    return e.join(F.broadcast(d), "expense_type_key", "inner")


# --------------------------------------------------------------------------- bonus fact

def dim_bonus_indicator(b) -> DataFrame:
    """Indicator dimension (A22): last row per indicator id."""
    from ..operators.dedupe import latest_per_key
    bi = b.bonus_indicators
    return latest_per_key(bi, ["idbonusindicator"], [F.col("codebonusindicator"), F.col("namebonusindicator")])


def player_bonuses(b, f, t) -> DataFrame:
    """Bonus transaction fact (F5); deleted rows are kept with their flag."""
    pb = b.bonuses.filter(day_between("datework", f, t) & known_member("membership"))
    d = _member_dims(b, pb, "timeoper", pb)
    g = b.games.select(F.col("idgame").alias("_gid"), F.col("namegame").alias("gamename"))
    d = d.join(g, F.col("idgame") == F.col("_gid"), "left")
    z = F.lit(0).cast(DEC)
    return d.select(
        "idplayerbonus", F.col("datework").alias("gamingday"), "timeoper", "membership",
        F.col("idagent").cast("int").alias("idagent"), "agentname", "citizenshipcountry", "typeoper",
        "idbonusindicator", "idgame", "gamename",
        F.coalesce(F.col("sumbonuses"), z).cast(DEC).alias("sumbonuses"),
        F.coalesce(F.col("costbonuses"), z).cast(DEC).alias("costbonuses"),
        "multiplierloyalty", "hours", "handsperhour", "averbet", "percentadt",
        adt_product("multiplierloyalty", "hours", "handsperhour", "averbet").alias("adt"),
        "comment", F.coalesce(F.col("isdeleted"), F.lit(False)).alias("isdeleted"))


def bonus_month(bonus_fact: DataFrame, since) -> DataFrame:
    """Monthly bonus summary per member."""
    bf = bonus_fact.filter(F.col("gamingday") >= F.lit(since))
    z = F.lit(0).cast(DEC)
    earned_adt = F.when((F.col("typeoper") == 1) & F.col("adt").isNotNull(), F.col("adt"))
    return bf.groupBy("membership", F.to_date(F.date_trunc("month", "gamingday")).alias("month")).agg(
        F.count(F.lit(1)).alias("bonus_entries"),
        F.sum(F.when(F.col("typeoper") == 1, F.col("sumbonuses")).otherwise(z)).cast(DEC).alias("total_earned"),
        F.sum(F.when(F.col("typeoper") == -1, F.col("sumbonuses")).otherwise(z)).cast(DEC).alias("total_reversed"),
        F.sum("sumbonuses").cast(DEC).alias("net_bonus"),
        avg_half_up(F.sum(earned_adt), F.count(earned_adt), scale=8).alias("avg_adt"))


def earned_bonuses(bonus_fact: DataFrame) -> DataFrame:
    """Earned-only consumer view."""
    return bonus_fact.filter(F.col("typeoper") == 1).select(
        "gamingday", "membership", "gamename", "typeoper", F.col("sumbonuses").alias("earned"),
        F.col("multiplierloyalty").alias("house_edge_pct"), "hours", "handsperhour", "averbet",
        F.col("adt").alias("average_daily_theoretical"), "percentadt", "comment")


# --------------------------------------------------------------------------- visit x session report

def numbered_visits(b, f, t) -> DataFrame:
    """Visits with their number within the member-day (E5): order by
    ``coalesce(time_in, created)`` NULLS LAST, then ``time_out`` NULLS LAST (then
    created, time_in, for a total order).  The row number is chunked by hour and, in a busy
    hour, by rank, so a member-day with very many visits is split over tasks."""
    v = silver.visits_in_range(b, f, t).select(
        F.col("datework").alias("gaming_day"), "membership", "time_in", "time_out", "created")
    first = F.coalesce("time_in", "created")
    order = [first.asc_nulls_last(), F.col("time_out").asc_nulls_last(), F.col("created").asc_nulls_last(),
             F.col("time_in").asc_nulls_last()]
    v, chunk = balanced_chunks(v, ["gaming_day", "membership"],
                               nulls_last(first, F.col("time_out"), F.col("created"), F.col("time_in")), hour_chunk(first))
    return chunked_row_number(v, ["gaming_day", "membership"], order, "visit_no", chunk=chunk) \
        .withColumn("visit_no", F.col("visit_no").cast("int")).drop("_sub")


def game_sessions(b, f, t) -> DataFrame:
    s = silver.sessions_tracked(b, f, t).filter(not_deleted("isdeleted"))
    return s.select(F.col("gamingday").alias("gaming_day"), "membership", "idplayersession", "timestart",
                    "timefinish", "averbet")


def time_text(c: Column | str) -> Column:
    """Time of day of a timestamp as text ``HH:mm:ss.SSSSSS`` (the TIME type is off in Spark)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "HH:mm:ss.SSSSSS")


def visit_sessions(b, f, t) -> DataFrame:
    """One row per visit x overlapping table session."""
    v = numbered_visits(b, f, t)
    s = game_sessions(b, f, t)
    j = overlap_left_join_bucketed(v, s, ["gaming_day", "membership"], ["gaming_day", "membership", "visit_no"],
                                   "time_in", "time_out", "timestart", "timefinish")
    return j.select("gaming_day", "membership", "visit_no",
                    time_text("time_in").alias("casino_entry_time"), time_text("time_out").alias("casino_exit_time"),
                    time_text("timestart").alias("session_start"), time_text("timefinish").alias("session_finish"),
                    F.col("averbet").cast(DEC).alias("averbet"))


def _minute_text(c: str) -> Column:
    return F.substring(F.col(c), 1, 5)


def visit_report_extract(report: DataFrame) -> DataFrame:
    """Fixed 8-column report (A25): minute-truncated times, literal 'NULL' for
    missing session cells."""
    return report.select(
        F.col("gaming_day").alias("GamingDay"), F.col("membership").alias("Membership"),
        F.col("visit_no").alias("VisitNo"),
        _minute_text("casino_entry_time").alias("CasinoEntryTime"),
        _minute_text("casino_exit_time").alias("CasinoExitTime"),
        F.coalesce(_minute_text("session_start"), F.lit("NULL")).alias("SessionStart"),
        F.coalesce(_minute_text("session_finish"), F.lit("NULL")).alias("SessionFinish"),
        F.coalesce(F.col("averbet").cast("string"), F.lit("NULL")).alias("averBet"))


# --------------------------------------------------------------------------- reconciliation

REPORT_COLS = ("gaming_day", "membership", "visit_no", "casino_entry_time", "casino_exit_time", "session_start",
               "session_finish", "averbet")


def normalize_report(df: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """Normalise a report side before comparing (H4): 'NULL' text -> NULL,
    times to whole seconds, amounts to 4 digits; the column set must match."""
    missing = [c for c in REPORT_COLS if c not in df.columns]
    if missing:
        raise ValueError(f"report columns missing: {missing}")

    def txt(c: str) -> Column:
        v = F.col(c).cast("string")
        v = F.when(F.upper(F.trim(v)) == "NULL", F.lit(None)).otherwise(v)
        return F.substring(v, 1, 8)

    return df.select("gaming_day", F.col("membership").cast("long").alias("membership"),
                     F.col("visit_no").cast("int").alias("visit_no"),
                     *[txt(c).alias(c) for c in REPORT_COLS[3:7]],
                     F.round(F.col("averbet").cast(DEC), 4).cast(DEC).alias("averbet"), *extra)


def reconcile(legacy: DataFrame, generated: DataFrame) -> DataFrame:
    """Two-sided multiset difference with multiplicities (H3/K4):
    ``side`` = 'only_in_legacy' / 'only_in_generated', ``n`` = surplus copies."""
    return multiset_difference(normalize_report(legacy), normalize_report(generated), list(REPORT_COLS),
                               "only_in_legacy", "only_in_generated")


def reconcile_top(diff: DataFrame, n: int = 15) -> DataFrame:
    """The n most repeated differing rows per side (G3); ties by the row values.

    Each side is a separate ``orderBy().limit()`` (a distributed top-k: every
    task keeps its n best rows, the driver merges at most n per task)."""
    order = [F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in REPORT_COLS]]
    parts = [diff.filter(F.col("side") == s).orderBy(*order).limit(n) for s in ("only_in_legacy", "only_in_generated")]
    return parts[0].unionByName(parts[1])


def reconcile_status(legacy: DataFrame, generated: DataFrame) -> DataFrame:
    """Exit status of a reconciliation (K4), one row: rows per side, surplus
    copies per side and ``status`` 0 (full match) or 1 (differences)."""
    both = difference_totals(normalize_report(legacy), normalize_report(generated), list(REPORT_COLS)).toDF(
        "legacy_rows", "generated_rows", "only_in_legacy", "only_in_generated")
    return both.withColumn("status", F.when((F.col("only_in_legacy") == 0) & (F.col("only_in_generated") == 0), 0)
                           .otherwise(1))
