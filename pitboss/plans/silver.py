"""Silver layer: day aggregates, the member-day fact and the player-session fact.

Functions take a ``Bronze`` accessor (``pitboss.sources.adapters.Bronze`` or
any object exposing the same DataFrames) and an inclusive day range.  They
only build lazy plans; nothing is collected.

Scale notes
* Every branch is filtered on its day column and member before any shuffle,
  so the anonymous member (a potential hot key) never reaches an exchange.
* ``membership_day`` is assembled by *stack and fold*: each branch emits rows
  ``(gamingday, membership, measures...)``; they are stacked with
  ``unionByName`` and folded with one ``groupBy`` (partial aggregation
  map-side, one shuffle), instead of twelve joins on the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import (ACC_AGENT_CREDIT, ACC_AGENT_TRANSFER, ACC_CASHDESK, ACC_LG_DISCOUNT,
                                  ACC_OPERATING_EXPENSE, ACC_PRIVATE_DEPOSIT, ACC_SLOT_DISCOUNT,
                                  ACC_TABLE_CASH, DROP_ACCOUNTS, EXPENSE_ACCOUNTS, MONEY_ACCOUNTS,
                                  agent_label_strict, expense_flags_sql)
from ..functions.predicates import (OPEN_END, clean_text, day_between, gaming_day, is_true, known_member,
                                    not_deleted, sign_split)
from ..operators.asof import agent_at
from ..operators.pool import clean_drop as _clean_drop, hour_chunk, pool_trace
from ..operators.scan import balanced_chunks, nulls_last, prefix_peaks
from ..sources.daypart import CARRIED, of_days

DEC = "decimal(19,4)"
KEYS = ["gamingday", "membership"]


ZERO = "CAST(0 AS DECIMAL(19,4))"


def _zero() -> Column:
    return F.expr(ZERO)


def _sum(c: str) -> Column:
    return F.expr(f"coalesce(sum({c}), {ZERO})")


def _cond_sql(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {value} ELSE {ZERO} END"


def _cond(cond: str, value: str) -> Column:
    """``CASE WHEN cond THEN value ELSE 0 END``.  Measure definitions are
    Spark SQL expression strings: one expression per measure to build, the
    same plan as the equivalent Column chain."""
    return F.expr(_cond_sql(cond, value))


# --------------------------------------------------------------------------- visits

def visits_in_range(b, f, t) -> DataFrame:
    return b.visits.filter(day_between("datework", f, t) & known_member("membership"))


def slots_in_range(b, f, t, known_only: bool = True) -> DataFrame:
    s = b.drgt_sessions.filter(day_between("gamingday", f, t))
    return s.filter(known_member("playerid")) if known_only else s


def visits_base(b, f, t) -> DataFrame:
    """Visit days (D2) plus slot-only days (D3 after the anti-join C8), UNION ALL (H1)."""
    v = (visits_in_range(b, f, t)
         .groupBy(F.col("datework").alias("gamingday"), "membership")
         .agg(F.min(F.coalesce("time_in", "created")).alias("visittime"),
              F.min("time_in").alias("time_in"), F.max("time_out").alias("time_out")))
    s = (slots_in_range(b, f, t)
         .groupBy("gamingday", F.col("playerid").alias("membership"))
         .agg(F.min("starttimelocal").alias("visittime"), F.min("starttimelocal").alias("time_in"),
              F.max("endtimelocal").alias("time_out")))
    slot_only = s.join(v.select(*KEYS), KEYS, "left_anti")
    return v.unionByName(slot_only)


def slot_days_without_visit(b, f, t) -> DataFrame:
    """Anti-join (C8): slot (day, member) pairs with no visit that day."""
    s = slots_in_range(b, f, t).select("gamingday", F.col("playerid").alias("membership")).distinct()
    v = visits_in_range(b, f, t).select(F.col("datework").alias("gamingday"), "membership")
    return s.join(v, KEYS, "left_anti")


# --------------------------------------------------------------------------- cashdesk

def cashdesk_in_range(b, f, t) -> DataFrame:
    """Shared cashdesk scan: day range, known member, not soft-deleted."""
    return b.cashdesk_tx.filter(day_between("datework", f, t) & known_member("membership")
                                & not_deleted("isdeleted"))


def money_per_oper(b, opers: DataFrame | None = None, days: tuple | None = None) -> DataFrame:
    """Money rows pre-aggregated per operation.

    A money table that carries its operation's day is cut down to the ``days``
    of the range.  Without that, a range filter cannot reach it: with ``opers``
    (the operation ids of the in-range cashdesk rows) the money rows are
    semi-joined to those ids before aggregating, so a one-day refresh
    aggregates one day of money rows, not the whole history.  The id set of a
    short range is small, so the planner can broadcast it (after measuring it)
    and filter the money scan without shuffling it."""
    m = b.tx_money
    if days is not None and CARRIED in m.columns:
        m = of_days(m, *days)
    elif opers is not None:
        m = m.join(opers.select("idoper"), "idoper", "left_semi")
    return m.groupBy("idoper").agg(F.sum("summoney").alias("summoney"))


def money_tx(b, f, t) -> DataFrame:
    """Cash movements of the drop accounts with the optional deposit detail (C4)."""
    c = cashdesk_in_range(b, f, t).filter(F.col("idaccount").isin(*MONEY_ACCOUNTS) & is_true("iscalculatedindrop"))
    c = c.join(of_days(b.tx_calculated, f, t), "idoper", "left")
    return c.select(
        F.col("datework").alias("gamingday"), "timeoper", "membership", "idoper", "idaccount",
        sign_split("directionoper", "totalmoneyue", 1).alias("inamt"),
        sign_split("directionoper", "totalmoneyue", -1).alias("outamtabs"),
        F.coalesce(F.col("totalmoneyue"), _zero()).cast(DEC).alias("totalmoneyue"),
        F.coalesce(F.col("deposit"), _zero()).cast(DEC).alias("deposit"),
    )


def drop_events(b, f, t) -> DataFrame:
    m = money_tx(b, f, t).filter(F.col("idaccount").isin(*DROP_ACCOUNTS))
    return m.select(*KEYS, "timeoper", "idoper",
                    _cond(f"idaccount IN ({', '.join(str(a) for a in DROP_ACCOUNTS)})", "inamt").alias("buyamt"),
                    _cond(f"idaccount = {ACC_CASHDESK}", "outamtabs").alias("outamt"))


def clean_drop_day(b, f, t, keys=KEYS) -> DataFrame:
    """Clean drop per member-day (E4), or per ``keys`` (e.g. member only)."""
    return _clean_drop(drop_events(b, f, t), list(keys), "timeoper", "idoper")


def drop_trace(b, f, t) -> DataFrame:
    """Row-level running sum / running min / pool."""
    return pool_trace(drop_events(b, f, t), KEYS, "timeoper", "idoper")


def _money_measures() -> dict[str, str]:
    """Row-level money measures (SQL over money_tx columns); the day value is the sum of each."""
    drop = ", ".join(str(a) for a in DROP_ACCOUNTS)
    return {
        "cashdesk_in": _cond_sql(f"idaccount = {ACC_CASHDESK}", "inamt"),
        "cashdesk_out": _cond_sql(f"idaccount = {ACC_CASHDESK}", "outamtabs"),
        "tablecash_in": _cond_sql(f"idaccount = {ACC_TABLE_CASH}", "inamt"),
        "totalexchange_in": _cond_sql(f"idaccount IN ({drop})", "inamt"),
        "agenttransfer_net": _cond_sql(f"idaccount = {ACC_AGENT_TRANSFER}", "totalmoneyue"),
        "privatedeposit_net": _cond_sql(f"idaccount = {ACC_PRIVATE_DEPOSIT}", "deposit"),
        "privatedeposit_add": _cond_sql(f"idaccount = {ACC_PRIVATE_DEPOSIT} AND deposit > 0", "deposit"),
        "privatedeposit_withdraw": _cond_sql(f"idaccount = {ACC_PRIVATE_DEPOSIT} AND deposit < 0", "deposit"),
    }


def money_day(b, f, t) -> DataFrame:
    """Conditional sums by account per member-day."""
    m = money_tx(b, f, t)
    aggs = [F.expr(f"CAST(sum({v}) AS {DEC})").alias(k) for k, v in _money_measures().items()]
    out = m.groupBy(*KEYS).agg(*aggs)
    return out.withColumn("totalexchange_net", (F.col("totalexchange_in") - F.col("cashdesk_out")).cast(DEC))


def _system_drop_value() -> Column:
    drop = ", ".join(str(a) for a in DROP_ACCOUNTS)
    return _cond(f"directionoper = 1 AND coalesce(iscalculatedindrop, false) AND idaccount IN ({drop})",
                 f"abs(coalesce(chipsue, {ZERO}))")


def system_drop(b, f, t) -> DataFrame:
    """System drop (D4): the account/flag conditions are inside the sum only."""
    c = cashdesk_in_range(b, f, t)
    return (c.groupBy(F.col("datework").alias("gamingday"), "membership")
            .agg(F.sum(_system_drop_value()).cast(DEC).alias("systemdrop_in")))


def expense_tx(b, f, t) -> DataFrame:
    c = cashdesk_in_range(b, f, t).filter(F.col("idaccount").isin(*EXPENSE_ACCOUNTS))
    c = c.join(money_per_oper(b, c, (f, t)), "idoper", "left")
    return c.select(F.col("datework").alias("gamingday"), "membership", "idaccount", "directionoper",
                    F.coalesce(F.col("summoney"), _zero()).cast(DEC).alias("summoney"),
                    F.coalesce(F.col("comment"), F.lit("")).alias("comment"))


def _expense_measures() -> dict[str, str]:
    """Row-level expense measures (SQL over expense_tx columns)."""
    fl = expense_flags_sql("comment")
    opex = f"idaccount = {ACC_OPERATING_EXPENSE}"
    credit = f"idaccount = {ACC_AGENT_CREDIT}"
    return {
        "expense_total": _cond_sql(opex, "summoney"),
        "expense_airtickets": _cond_sql(f"{opex} AND {fl['air']}", "summoney"),
        "expense_discount_plus": _cond_sql(f"{opex} AND {fl['discount_plus']}", "summoney"),
        "expense_hotel": _cond_sql(f"{opex} AND {fl['hotel']}", "summoney"),
        "expense_other": _cond_sql(f"{opex} AND {fl['other']}", "summoney"),
        "discount_lg": _cond_sql(f"idaccount = {ACC_LG_DISCOUNT}", "summoney"),
        "discount_slot": _cond_sql(f"idaccount = {ACC_SLOT_DISCOUNT}", "summoney"),
        "agent_credit_out": _cond_sql(f"{credit} AND directionoper = 1", "summoney"),
        "agent_credit_void": _cond_sql(f"{credit} AND directionoper = -1", "summoney"),
        "agent_credit_net": _cond_sql(credit, "summoney"),
    }


def expense_day(b, f, t) -> DataFrame:
    """Ten conditional sums over the overlapping category flags."""
    e = expense_tx(b, f, t)
    return e.groupBy(*KEYS).agg(*[F.expr(f"CAST(sum({v}) AS {DEC})").alias(k) for k, v in _expense_measures().items()])


# --------------------------------------------------------------------------- table sessions

def sessions_tracked(b, f, t) -> DataFrame:
    """Sessions joined once to tracking (C1), filtered on the tracking day."""
    pt = b.players_tracking.filter(day_between("datework", f, t) & known_member("membership"))
    ps = of_days(b.player_sessions, f, t)
    return ps.join(pt, "idplayerstracking", "inner").withColumn("gamingday", F.col("datework"))


def session_count_day(b, f, t) -> DataFrame:
    """Session count per member-day (D6); soft-deleted sessions are counted."""
    return sessions_tracked(b, f, t).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("sessionscnt"))


def _session_micros() -> Column:
    """Played time of one session in microseconds; NULL ends or finish < start give 0."""
    st, fi = F.col("timestart"), F.col("timefinish")
    return (F.when(st.isNull() | fi.isNull(), F.lit(0).cast("long"))
            .when(fi < st, F.lit(0).cast("long"))
            .otherwise(F.timestamp_diff("MICROSECOND", st, fi)))


def micros_to_minutes(total_micros: Column) -> Column:
    """One exact division after the sum (decimal(28,0)/60e6 -> decimal(37,9)), then HALF_UP to 4."""
    return (total_micros.cast("decimal(28,0)") / F.lit(60000000)).cast(DEC)


def minutes_day(b, f, t) -> DataFrame:
    """Minutes played per member-day (D7), soft-deleted sessions excluded."""
    s = sessions_tracked(b, f, t).filter(not_deleted("isdeleted"))
    return s.groupBy(*KEYS).agg(micros_to_minutes(F.sum(_session_micros())).alias("minutes_played"))


def tracking_sessions(b, f, t) -> DataFrame:
    """Chip float per session (D8 level 1): chain session→tracking→details→chips→value (C10),
    rounded to 4 digits per session."""
    s = sessions_tracked(b, f, t).filter(not_deleted("isdeleted")).select(*KEYS, "idplayersession")
    chain = (s.join(of_days(b.session_details, f, t), "idplayersession", "inner")
             .join(of_days(b.session_detail_chips, f, t), "idplayersessiondetail", "inner")
             .join(b.chips, "idchip", "inner"))
    q, v = F.col("qntchips"), F.col("valuechip")
    return chain.groupBy(*KEYS, "idplayersession").agg(
        F.sum(F.when(q > 0, q * v).otherwise(F.lit(0))).cast(DEC).alias("floatin_ue"),
        F.sum(F.when(q < 0, -q * v).otherwise(F.lit(0))).cast(DEC).alias("floatout_ue"),
        F.sum(q * v).cast(DEC).alias("net_ue"))


def tracking_day(b, f, t) -> DataFrame:
    """Chip float per member-day (D8 level 2)."""
    return tracking_sessions(b, f, t).groupBy(*KEYS).agg(
        F.sum("floatin_ue").cast(DEC).alias("tracking_floatin"),
        F.sum("floatout_ue").cast(DEC).alias("tracking_floatout"),
        F.sum("net_ue").cast(DEC).alias("tracking_net"))


# --------------------------------------------------------------------------- slots

SLOT_SCALED = ("totalbet", "cashbet", "totalout", "win", "nwl", "billdrop")


def _hundredths(total: Column) -> Column:
    """Amounts kept in hundredths: exact ``x * 0.01`` then HALF_UP to 4 digits."""
    return (total * F.lit(0.01).cast("decimal(3,2)")).cast(DEC)


def slot_day(b, f, t) -> DataFrame:
    """Slot measures per member-day (D5); no member filter, as in the source."""
    s = slots_in_range(b, f, t, known_only=False)
    aggs = [_hundredths(F.sum(F.coalesce(F.col(c), _zero()))).alias(f"slot_{c}") for c in SLOT_SCALED]
    aggs += [F.sum(F.coalesce(F.col("gamesplayed"), _zero())).cast(DEC).alias("slot_gamesplayed"),
             F.count(F.lit(1)).alias("slot_sessions_cnt")]
    return s.groupBy("gamingday", F.col("playerid").alias("membership")).agg(*aggs)


# --------------------------------------------------------------------------- member-day fact

DAY_MEASURES = (
    "totaldrop_clean", "systemdrop_in", "totalcash_in", "totalcash_result", "cashdesk_in", "cashdesk_out",
    "tablecash_in", "agenttransfer_net", "junketdeposit_add", "junketdeposit_withdraw", "junketdeposit_net",
    "sessionscnt", "minutes_played", "slot_totalbet", "slot_cashbet", "slot_totalout", "slot_win", "slot_nwl",
    "slot_billdrop", "slot_gamesplayed", "slot_sessions_cnt", "tracking_floatin", "tracking_floatout",
    "tracking_net", "expense_total", "expense_airtickets", "expense_discount_plus", "expense_hotel",
    "expense_other", "discount_lg", "discount_slot", "agent_credit_out", "agent_credit_void", "agent_credit_net",
)
DAY_COLUMNS = ("gamingday", "membership", "surname", "forename", "idagent", "agentname",
               "citizenshipcountry") + DAY_MEASURES


def _stacked_branches(b, f, t) -> DataFrame:
    """All member-day branches as rows of one wide schema (missing columns NULL)."""
    visits = visits_in_range(b, f, t).select(
        F.col("datework").alias("gamingday"), "membership",
        F.coalesce("time_in", "created").alias("_v_time"), F.col("time_in").alias("_v_in"),
        F.col("time_out").alias("_v_out"), F.lit(1).alias("_is_visit"))
    slots = slots_in_range(b, f, t).select(
        "gamingday", F.col("playerid").alias("membership"),
        F.col("starttimelocal").alias("_s_start"), F.col("endtimelocal").alias("_s_end"),
        F.lit(1).alias("_is_slot"),
        *[F.coalesce(F.col(c), _zero()).alias(f"_slot_{c}") for c in SLOT_SCALED + ("gamesplayed",)])

    # One cashdesk scan feeds the money, system-drop and expense measures and the clean drop.
    c = cashdesk_in_range(b, f, t)
    expense_opers = c.filter(F.col("idaccount").isin(*EXPENSE_ACCOUNTS))
    c = (c.join(of_days(b.tx_calculated, f, t), "idoper", "left")
         .join(money_per_oper(b, expense_opers, (f, t)), "idoper", "left"))
    acc = F.col("idaccount")
    in_money = acc.isin(*MONEY_ACCOUNTS) & is_true("iscalculatedindrop")
    in_expense = acc.isin(*EXPENSE_ACCOUNTS)
    c = c.select(
        F.col("datework").alias("gamingday"), "membership", "timeoper", "idoper", "idaccount", "directionoper",
        "chipsue", "iscalculatedindrop", in_money.alias("_in_money"), in_expense.alias("_in_expense"),
        sign_split("directionoper", "totalmoneyue", 1).alias("inamt"),
        sign_split("directionoper", "totalmoneyue", -1).alias("outamtabs"),
        F.coalesce(F.col("totalmoneyue"), _zero()).cast(DEC).alias("totalmoneyue"),
        F.coalesce(F.col("deposit"), _zero()).cast(DEC).alias("deposit"),
        F.coalesce(F.col("summoney"), _zero()).cast(DEC).alias("summoney"),
        F.coalesce(F.col("comment"), F.lit("")).alias("comment"))
    drop = ", ".join(str(a) for a in DROP_ACCOUNTS)
    net = F.expr(f"CASE WHEN _in_money AND idaccount IN ({drop}) THEN inamt - "
                 f"CASE WHEN idaccount = {ACC_CASHDESK} THEN outamtabs ELSE {ZERO} END ELSE {ZERO} END")
    sums = [F.sum(_system_drop_value()).alias("_sysdrop"),
            *[F.expr(f"sum(CASE WHEN _in_money THEN {v} END)").alias(f"_m_{k}") for k, v in _money_measures().items()],
            *[F.expr(f"sum(CASE WHEN _in_expense THEN {v} END)").alias(f"_e_{k}")
              for k, v in _expense_measures().items()]]
    c, chunk = balanced_chunks(c, KEYS, [*nulls_last(F.col("timeoper")), F.col("idoper")], hour_chunk("timeoper"),
                               counted=cashdesk_in_range(b, f, t).withColumnRenamed("datework", "gamingday"))
    cash = prefix_peaks(c, KEYS, [F.col("timeoper").asc_nulls_last(), F.col("idoper").asc()], net, "_peak", chunk, sums)

    out = visits
    for part in (slots, cash, session_float(b, f, t)):
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def session_float(b, f, t) -> DataFrame:
    """Per session id: how many rows it has (``_sess``), its played time (``_micros``)
    and its chip float (D6, D7 and D8 of one sessions x tracking join)."""
    live = not_deleted("isdeleted")
    s = (sessions_tracked(b, f, t).groupBy(*KEYS, "idplayersession")
         .agg(F.count(F.lit(1)).alias("_sess"), F.sum(F.when(live, _session_micros())).alias("_micros"),
              F.count_if(live).alias("_live")))
    d = of_days(b.session_details, f, t).select(F.col("idplayersession").alias("_session"), "idplayersessiondetail")
    chips = (of_days(b.session_detail_chips, f, t).join(b.chips, "idchip", "inner")
             .select(F.col("idplayersessiondetail").alias("_detail"), "qntchips", "valuechip"))
    rows = (s.join(d, (F.col("idplayersession") == F.col("_session")) & (F.col("_live") > 0), "left")
            .join(chips, F.col("idplayersessiondetail") == F.col("_detail"), "left"))
    q, v = F.col("qntchips"), F.col("valuechip")
    copies = F.col("_live").cast("decimal(10,0)")     # a session id of several rows counts its chips for each

    def per_session(total: Column) -> Column:
        return (total.cast("decimal(28,8)") * F.max(copies)).cast(DEC)
    return rows.groupBy(*KEYS, "idplayersession").agg(
        F.max("_sess").alias("_sess"), F.max("_micros").alias("_micros"),
        per_session(F.sum(F.when(q > 0, q * v).when(q.isNotNull(), F.lit(0)))).alias("_t_in"),
        per_session(F.sum(F.when(q < 0, -q * v).when(q.isNotNull(), F.lit(0)))).alias("_t_out"),
        per_session(F.sum(q * v)).alias("_t_net")).drop("idplayersession")


def _fold(stacked: DataFrame) -> DataFrame:
    has_visit = F.max("_is_visit").isNotNull()
    g = stacked.groupBy(*KEYS).agg(
        has_visit.alias("_has_visit"), F.max("_is_slot").isNotNull().alias("_has_slot"),
        F.when(has_visit, F.min("_v_time")).otherwise(F.min("_s_start")).alias("visittime"),
        F.greatest(F.max("_peak"), _zero()).cast(DEC).alias("totaldrop_clean"),
        _sum("_sysdrop").alias("systemdrop_in"),
        _sum("_m_totalexchange_in").alias("totalcash_in"),
        (_sum("_m_totalexchange_in") - _sum("_m_cashdesk_out")).alias("totalcash_result"),
        _sum("_m_cashdesk_in").alias("cashdesk_in"),
        _sum("_m_cashdesk_out").alias("cashdesk_out"),
        _sum("_m_tablecash_in").alias("tablecash_in"),
        _sum("_m_agenttransfer_net").alias("agenttransfer_net"),
        (-_sum("_m_privatedeposit_add")).alias("junketdeposit_add"),
        (-_sum("_m_privatedeposit_withdraw")).alias("junketdeposit_withdraw"),
        (-_sum("_m_privatedeposit_net")).alias("junketdeposit_net"),
        F.coalesce(F.sum("_sess"), F.lit(0)).cast("long").alias("sessionscnt"),
        micros_to_minutes(F.coalesce(F.sum("_micros"), F.lit(0))).alias("minutes_played"),
        *[_hundredths(_sum(f"_slot_{c}")).alias(f"slot_{c}") for c in SLOT_SCALED],
        _sum("_slot_gamesplayed").alias("slot_gamesplayed"),
        F.coalesce(F.sum("_is_slot"), F.lit(0)).cast("long").alias("slot_sessions_cnt"),
        _sum("_t_in").alias("tracking_floatin"),
        _sum("_t_out").alias("tracking_floatout"),
        _sum("_t_net").alias("tracking_net"),
        *[_sum(f"_e_{k}").alias(k) for k in _expense_measures()],
    )
    return g.filter(F.col("_has_visit") | F.col("_has_slot")).drop("_has_visit", "_has_slot")


def visit_times(b, f, t) -> DataFrame:
    """First visit time of every member-day, else the first slot time."""
    v = visits_in_range(b, f, t).select(F.col("datework").alias("gamingday"), "membership",
                                        F.coalesce("time_in", "created").alias("_v"), F.lit(1).alias("_is_visit"))
    s = slots_in_range(b, f, t).select("gamingday", F.col("playerid").alias("membership"),
                                       F.col("starttimelocal").alias("_s"))
    return v.unionByName(s, allowMissingColumns=True).groupBy(*KEYS).agg(
        F.when(F.max("_is_visit").isNotNull(), F.min("_v")).otherwise(F.min("_s")).alias("visittime"))


def membership_day(b, f, t, agent_id: int | None = None, split_hot_members: bool = True) -> DataFrame:
    """The 41-column member-day fact (F1)."""
    folded = _fold(_stacked_branches(b, f, t)).drop("visittime")
    players = b.players.select("membership", "idagent", "surname", "forename", "idcountry")
    # Members of the range straight from the visit and slot scans: a cheap key
    # set for pruning the agent history (the folded rows are a large plan).
    members = visits_in_range(b, f, t).select("membership").unionByName(
        slots_in_range(b, f, t).select(F.col("playerid").alias("membership"))).distinct()
    # The look-up reads its probes twice (rows and chunk ends): visit times come
    # from the same two scans, so that the folded rows are computed once.
    agent = agent_at(visit_times(b, f, t), b.agents_players, players, "membership", "visittime",
                     split_by_day=split_hot_members, player_cols=("surname", "forename", "idcountry"),
                     member_keys=members)
    with_agent = folded.join(agent.drop("visittime"), KEYS)
    ag = b.agents.select(F.col("idagent").alias("_aid"), F.col("nameagent"))
    cc = b.countries.select(F.col("idcountry").alias("_cid"), F.col("namecountry"))
    d = (with_agent.join(ag, F.col("idagent") == F.col("_aid"), "left")
         .join(cc, F.col("idcountry") == F.col("_cid"), "left"))
    d = d.select(
        "gamingday", "membership",
        clean_text("surname").alias("surname"), clean_text("forename").alias("forename"),
        F.col("idagent").cast("int").alias("idagent"),
        agent_label_strict(F.col("idagent"), F.col("nameagent")).alias("agentname"),
        F.col("namecountry").alias("citizenshipcountry"),
        *[F.col(m).cast("long" if m.endswith("cnt") else DEC).alias(m) for m in DAY_MEASURES])
    if agent_id is not None:
        d = d.filter(F.col("idagent") == F.lit(agent_id))
    return d


def agent_at_visit(b, f, t, split_hot_members: bool = False) -> DataFrame:
    """As-of agent per visit day."""
    vb = visits_base(b, f, t).select(*KEYS, "visittime")
    players = b.players.select("membership", "idagent")
    members = visits_in_range(b, f, t).select("membership").unionByName(
        slots_in_range(b, f, t).select(F.col("playerid").alias("membership"))).distinct()
    return agent_at(vb, b.agents_players, players, "membership", "visittime", split_by_day=split_hot_members,
                    member_keys=members).select(*KEYS, F.col("idagent").cast("int").alias("idagent"))


# --------------------------------------------------------------------------- player-session fact

def agent_group_for(keys: DataFrame, groups: DataFrame, day_col: str = "gamingday") -> DataFrame:
    """Range/SCD top-1 (C6): for each distinct (idagent, day) the group with
    ``datebegin <= day <= coalesce(dateend, 2999-12-31)``, latest ``datebegin``
    then latest ``modified`` (then highest id, to make the pick total).

    Only the distinct (agent, day) pairs meet the range predicate, so the
    session table itself is never multiplied by the candidate groups."""
    pairs = keys.select("idagent", day_col).filter(F.col("idagent").isNotNull()).distinct()
    g = groups.select(F.col("idagent").alias("_gagent"), "idagentgroup", "datebegin", "dateend", "modified")
    cand = pairs.join(g, (F.col("idagent") == F.col("_gagent"))
                      & (F.col(day_col) >= F.col("datebegin"))
                      & (F.col(day_col) <= F.coalesce(F.col("dateend"), F.lit(OPEN_END))), "inner")
    best = cand.groupBy("idagent", day_col).agg(
        F.max(F.struct(F.col("datebegin"), F.col("modified").isNull().alias("_mn"), F.col("modified"),
                       F.col("idagentgroup"))).alias("_best"))
    return best.select("idagent", day_col, F.col("_best.idagentgroup").alias("idagentgroup"))


def player_session(b, f, t) -> DataFrame:
    """Player-session fact (F3); the agent is the player's current agent."""
    # a tracking row with a day must have it in the range: only rows without a
    # day depend on their session's start, so the day reaches the scan
    pt = b.players_tracking.filter(known_member("membership")
                                   & (day_between("datework", f, t) | F.col("datework").isNull()))
    ps = of_days(b.player_sessions, f, t).filter(not_deleted("isdeleted"))
    s = ps.join(pt, "idplayerstracking", "inner").withColumn("gamingday", gaming_day("datework", "timestart"))
    s = s.filter(day_between("gamingday", f, t))
    pl = b.players.select(F.col("membership").alias("_pm"), "idagent")
    s = s.join(pl, F.col("membership") == F.col("_pm"), "left").drop("_pm")
    grp = agent_group_for(s, b.agent_groups)
    s = s.join(grp, ["idagent", "gamingday"], "left")
    money_cols = ("realdrop", "chipsin", "chipsout", "handhold", "cashout", "averbet")
    return s.select("idplayerstracking", "timestart", "gamingday", "membership", "idplayersession", "timefinish",
                    "idtable", "idgame", "idslot", F.col("idagent").cast("int").alias("idagent"), "idagentgroup",
                    *[F.coalesce(F.col(c), _zero()).cast(DEC).alias(c) for c in money_cols])


def fx_rate_daily(b, f, t) -> DataFrame:
    """FX rates of the day range (F7), from the upserted source."""
    r = b.fx_rates.filter(day_between("datechange", f, t))
    return r.select("idcasino", "datechange", "idcurrency", "idcurrencyexchrate", "exchrate", "row_version", "created",
                    "modified")


# Reference dimensions: bronze shape, key, columns.
REFERENCE_DIMS = {
    "dim_game": ("games", ("idgame",), ("idgame", "codegame", "namegame", "listorder_game", "idbonussystem", "nmbboxes")),
    "dim_table_type": ("table_types", ("idtabletype",), (
        "idtabletype", "codetabletype", "nametabletype", "listorder_tabletype", "idgametype")),
    "bridge_table_type_game": ("table_type_games", ("idtabletype", "idgame"), ("idtabletype", "idgame", "listorder")),
    "dim_table": ("tables_ref", ("idtable",), (
        "idtable", "idtabletype", "nametable", "snmbtable", "codetable", "isvirtual", "listorder_table", "idbonusgame",
        "idbonussystem", "ismarketing", "idcurrency", "mysteryguarantee", "ratemystery", "lowerlimitmystery",
        "upperlimitmystery", "minplayingbet")),
    "dim_agent_group_scd": ("agent_groups", ("idagentgroup",), (
        "idagentgroup", "idagent", "nameagent", "nameagentgroup", "datebegin", "dateend", "memoagentgroup",
        "row_version", "modified")),
}


def reference_dim(b, name: str) -> DataFrame:
    """Source rows of one reference dimension (F8); agent groups carry their agent's name."""
    shape, _, cols = REFERENCE_DIMS[name]
    rows = getattr(b, shape)
    if "nameagent" in cols:
        a = b.agents.select(F.col("idagent").alias("_aid"), "nameagent")
        rows = rows.join(a, rows["idagent"] == a["_aid"], "left")
    return rows.select(*cols)


def load_reference_dims(b, stored=None) -> dict[str, DataFrame]:
    """Reference dimensions after their keyed upserts (F8/A20) over ``stored``
    (name -> DataFrame; none: empty): never deletes, every non-key column is
    replaced by the source row's."""
    from ..operators.dedupe import upsert_last_wins
    out = {}
    for name, (_, key, _) in REFERENCE_DIMS.items():
        rows = reference_dim(b, name)
        target = (stored or {}).get(name, rows.filter(F.lit(False)))
        out[name] = upsert_last_wins(target, rows, list(key), F.lit(0))
    return out
