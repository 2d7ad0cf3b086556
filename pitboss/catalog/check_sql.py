"""DuckDB forms of the facts' meaning, for the checks.

They are stated as rules and lists of entries rather than as the engine
computes them: amounts are booked to measures by rule tables, an agent at a
time is an ASOF join, comment kinds come from a word table, and every
day-level measure is one entry in a ledger that is summed per member-day.
"""

from __future__ import annotations

from .adapter_sql import F_DAY, T_DAY

DEC = "DECIMAL(19,4)"
RANGE = f"BETWEEN {F_DAY} AND {T_DAY}"


def known(col: str) -> str:
    return f"{col} IS NOT NULL AND {col} <> 5"


def agent_at(name: str, source: str, time: str) -> str:
    """CTE ``name``: rows of ``source`` with ``agent_at``, the member's agent at ``time``."""
    return f"""
{name} AS (
  SELECT x.*, coalesce(h.idagent, nullif(own.idagent, 0)) AS agent_at
  FROM {source} x
  ASOF LEFT JOIN agents_players h ON x.membership = h.membership AND x.{time} >= h.datechange
  LEFT JOIN players own ON own.membership = x.membership)"""


# Words of comment kinds, lower-cased.
KINDS = """
words(kind, word) AS (VALUES
  ('air', 'air ticket'), ('air', 'flight'), ('air', 'fly ticket'), ('air', 'air tiket'), ('air', 'air tichets'),
  ('air', 'air tickat'), ('air', 'air tickent'), ('air', 'ticket cost'), ('air', 'tickets cost'), ('air', 'ticket payment'),
  ('plus', 'discount'), ('plus', 'discaunt'), ('plus', 'discont'), ('plus', 'discout'), ('plus', 'disccount'),
  ('plus', 'dsicount'), ('plus', 'difference'),
  ('hotel', 'hotel'), ('hotel', 'room payment'), ('hotel', 'acommodation'), ('hotel', 'accommodation')),
kinds AS (
  SELECT t.comment, list(DISTINCT w.kind) AS kinds
  FROM (SELECT DISTINCT comment FROM cashdesk_tx WHERE comment IS NOT NULL) t
  JOIN words w ON contains(lower(t.comment), w.word) GROUP BY t.comment)"""

# First rule that fits an operation, by account, direction and kind.
EXPENSE_KEYS = KINDS + """,
key_rules(expense_type_key, account, direction, kind) AS (VALUES
  (1, 641, NULL, 'air'), (2, 641, NULL, 'plus'), (3, 641, NULL, 'hotel'), (4, 641, NULL, NULL),
  (5, 153, 1, NULL), (6, 153, -1, NULL), (7, 151, NULL, NULL), (8, 154, NULL, NULL)),
keyed AS (
  SELECT c.idoper, CAST(min(r.expense_type_key) AS INT) AS expense_type_key
  FROM cashdesk_tx c LEFT JOIN kinds k ON k.comment = c.comment
  LEFT JOIN key_rules r ON r.account = c.idaccount AND (r.direction IS NULL OR r.direction = c.directionoper)
    AND (r.kind IS NULL OR list_contains(k.kinds, r.kind))
  GROUP BY c.idoper)"""

PAID = """
paid AS (SELECT idoper, sum(summoney) AS summoney FROM tx_money GROUP BY idoper)"""

# The expense-type dimension.
EXPENSE_TYPES = """(VALUES
  (1, 641, NULL, 'Operating Expense', 'Air Tickets', 1), (2, 641, NULL, 'Operating Expense', 'Discount+', 2),
  (3, 641, NULL, 'Operating Expense', 'Hotel', 3), (4, 641, NULL, 'Operating Expense', 'Other', 4),
  (5, 153, 1, 'Agent Credit', 'Agent Out', 5), (6, 153, -1, 'Agent Credit', 'Agent Void', 6),
  (7, 151, NULL, 'Discount', 'LG Discount', 7), (8, 154, NULL, 'Discount', 'Slot Discount', 8))
  AS d(expense_type_key, account_id, direction, expense_group, expense_type, sort_order)"""

# ---- presence: a member-day has visits, or else slot play
VISITS_BASE = f"""
presence AS (
  SELECT datework AS gamingday, membership, coalesce(time_in, created) AS since, time_in, time_out, 'visit' AS via
  FROM visits WHERE datework {RANGE} AND {known('membership')}
  UNION ALL
  SELECT gamingday, playerid, starttimelocal, starttimelocal, endtimelocal, 'slot'
  FROM drgt WHERE gamingday {RANGE} AND {known('playerid')}),
visits_base AS (
  SELECT gamingday, membership, min(since) AS visittime, min(time_in) AS time_in, max(time_out) AS time_out
  FROM presence
  SEMI JOIN (SELECT gamingday, membership, max(via) AS via FROM presence GROUP BY ALL) best
    USING (gamingday, membership, via)
  GROUP BY ALL)"""

# ---- cash operations and the measures they are booked to
MONEY_TX = f"""
desk AS (
  SELECT * FROM cashdesk_tx WHERE datework {RANGE} AND {known('membership')} AND isdeleted IS DISTINCT FROM true),
money_tx AS (
  SELECT t.datework AS gamingday, t.timeoper, t.membership, t.idoper, t.idaccount,
    CAST(abs(coalesce(t.totalmoneyue, 0)) * (t.directionoper IS NOT DISTINCT FROM 1)::INT AS {DEC}) AS inamt,
    CAST(abs(coalesce(t.totalmoneyue, 0)) * (t.directionoper IS NOT DISTINCT FROM -1)::INT AS {DEC}) AS outamtabs,
    CAST(coalesce(t.totalmoneyue, 0) AS {DEC}) AS totalmoneyue,
    CAST(coalesce(e.deposit, 0) AS {DEC}) AS deposit
  FROM desk t LEFT JOIN tx_calculated e ON e.idoper = t.idoper
  WHERE t.iscalculatedindrop AND list_contains([121, 703, 802, 803], t.idaccount))"""

DROP_EVENTS = MONEY_TX + f""",
drop_events AS (
  SELECT gamingday, membership, timeoper, idoper, inamt AS buyamt,
    CAST(outamtabs * (idaccount = 121)::INT AS {DEC}) AS outamt
  FROM money_tx SEMI JOIN (VALUES (121), (703)) a(idaccount) USING (idaccount))"""

MONEY_BOOKED = """
money_rules(account, measure, part, sign) AS (VALUES
  (121, 'cashdesk_in', 'in', 1), (121, 'cashdesk_out', 'out', 1), (703, 'tablecash_in', 'in', 1),
  (121, 'exchange_in', 'in', 1), (703, 'exchange_in', 'in', 1),
  (121, 'exchange_net', 'in', 1), (703, 'exchange_net', 'in', 1), (121, 'exchange_net', 'out', -1),
  (802, 'agenttransfer', 'net', 1), (803, 'deposit_net', 'deposit', 1), (803, 'deposit_add', 'up', 1),
  (803, 'deposit_withdraw', 'down', 1)),
money_booked AS (
  SELECT t.gamingday, t.membership, r.measure,
    r.sign * CASE r.part WHEN 'in' THEN t.inamt WHEN 'out' THEN t.outamtabs WHEN 'net' THEN t.totalmoneyue
                         WHEN 'deposit' THEN t.deposit WHEN 'up' THEN greatest(t.deposit, 0)
                         ELSE least(t.deposit, 0) END AS amount
  FROM money_tx t JOIN money_rules r ON r.account = t.idaccount)"""

SYSTEM_DROP = """
system_drop AS (
  SELECT datework AS gamingday, membership, coalesce(sum(abs(chipsue)) FILTER (
    WHERE directionoper = 1 AND iscalculatedindrop AND idaccount IN (121, 703)), 0) AS amount
  FROM desk GROUP BY ALL)"""

EXPENSE_TX = f"""
expense_tx AS (
  SELECT t.datework AS gamingday, t.membership, t.idaccount, t.directionoper,
    CAST(coalesce(p.summoney, 0) AS {DEC}) AS summoney, coalesce(t.comment, '') AS comment
  FROM cashdesk_tx t LEFT JOIN paid p ON p.idoper = t.idoper
  WHERE t.datework {RANGE} AND {known('t.membership')} AND t.isdeleted IS DISTINCT FROM true
    AND list_contains([151, 153, 154, 641], t.idaccount))"""

EXPENSE_BOOKED = """
expense_rules(measure, account, direction, kind) AS (VALUES
  ('expense_total', 641, NULL, NULL), ('expense_airtickets', 641, NULL, 'air'), ('expense_discount_plus', 641, NULL, 'plus'),
  ('expense_hotel', 641, NULL, 'hotel'), ('expense_other', 641, NULL, 'none'), ('discount_lg', 151, NULL, NULL),
  ('discount_slot', 154, NULL, NULL), ('agent_credit_out', 153, 1, NULL), ('agent_credit_void', 153, -1, NULL),
  ('agent_credit_net', 153, NULL, NULL)),
expense_booked AS (
  SELECT t.gamingday, t.membership, r.measure, t.summoney AS amount
  FROM expense_tx t LEFT JOIN kinds k ON k.comment = t.comment
  JOIN expense_rules r ON r.account = t.idaccount AND (r.direction IS NULL OR r.direction = t.directionoper)
    AND (r.kind IS NULL OR list_contains(coalesce(k.kinds, ['none']), r.kind)))"""
EXPENSE_MEASURES = ("expense_total", "expense_airtickets", "expense_discount_plus", "expense_hotel", "expense_other",
                    "discount_lg", "discount_slot", "agent_credit_out", "agent_credit_void", "agent_credit_net")

# ---- table sessions
SESSIONS = f"""
sess AS (
  SELECT t.datework AS gamingday, t.membership, s.*
  FROM players_tracking t JOIN player_sessions s ON s.idplayerstracking = t.idplayerstracking
  WHERE t.datework {RANGE} AND {known('t.membership')}),
live AS (SELECT * FROM sess WHERE isdeleted IS DISTINCT FROM true)"""

# Minutes, exact: total microseconds of the sessions that end after they
# start, HALF_UP to 1e-4 minute with integer arithmetic.
MINUTES = f"""CAST(CAST((coalesce(sum(date_diff('microsecond', timestart, timefinish))
    FILTER (WHERE timefinish >= timestart), 0) + 3000) // 6000 AS DECIMAL(38,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS {DEC})"""

TRACK = f"""
chip_moves AS (
  SELECT d.idplayersession, c.qntchips > 0 AS given, c.qntchips < 0 AS taken, c.qntchips * v.valuechip AS worth
  FROM chips v JOIN session_detail_chips c ON c.idchip = v.idchip
  JOIN session_details d ON d.idplayersessiondetail = c.idplayersessiondetail),
track_sess AS (
  SELECT l.gamingday, l.membership, l.idplayersession,
    CAST(coalesce(sum(m.worth) FILTER (WHERE m.given), 0) AS {DEC}) AS floatin_ue,
    CAST(-coalesce(sum(m.worth) FILTER (WHERE m.taken), 0) AS {DEC}) AS floatout_ue,
    CAST(sum(m.worth) AS {DEC}) AS net_ue
  FROM live l JOIN chip_moves m ON m.idplayersession = l.idplayersession
  GROUP BY ALL)"""

PLAYER_SESSION = f"""
timed AS (
  SELECT s.*, t.membership, coalesce(t.datework, CAST(s.timestart AS DATE)) AS gamingday, p.idagent
  FROM players_tracking t JOIN player_sessions s ON s.idplayerstracking = t.idplayerstracking
  LEFT JOIN players p ON p.membership = t.membership
  WHERE {known('t.membership')} AND s.isdeleted IS DISTINCT FROM true),
group_days AS (
  SELECT k.idagent, k.gamingday,
    (max({{'since': g.datebegin, 'open': g.modified IS NULL, 'changed': g.modified, 'id': g.idagentgroup}})).id AS idagentgroup
  FROM (SELECT DISTINCT idagent, gamingday FROM timed) k
  JOIN agent_groups g ON g.idagent = k.idagent AND k.gamingday >= g.datebegin
    AND (g.dateend IS NULL OR k.gamingday <= g.dateend)
  GROUP BY k.idagent, k.gamingday),
ps AS (
  SELECT s.idplayerstracking, s.timestart, s.gamingday, s.membership, s.idplayersession, s.timefinish, s.idtable, s.idgame,
    s.idslot, s.idagent, g.idagentgroup,
    {', '.join(f"CAST(coalesce(s.{c}, 0) AS {DEC}) AS {c}" for c in
               ("realdrop", "chipsin", "chipsout", "handhold", "cashout", "averbet"))}
  FROM timed s LEFT JOIN group_days g ON g.idagent = s.idagent AND g.gamingday = s.gamingday
  WHERE s.gamingday {RANGE})"""

# ---- transaction facts
EXPENSE_FACT = EXPENSE_KEYS + "," + PAID + f""",
spent AS (
  SELECT t.*, k.expense_type_key, p.summoney
  FROM keyed k JOIN cashdesk_tx t ON t.idoper = k.idoper LEFT JOIN paid p ON p.idoper = t.idoper
  WHERE k.expense_type_key IS NOT NULL AND t.datework {RANGE} AND {known('t.membership')}
    AND t.isdeleted IS DISTINCT FROM true),""" + agent_at("spent_by", "spent", "timeoper") + f""",
e AS (
  SELECT s.idoper, s.expense_type_key, s.datework AS gamingday, s.membership, CAST(s.agent_at AS INT) AS idagent,
    coalesce(a.nameagent, 'NO AGENT') AS agentname, n.namecountry AS citizenshipcountry,
    CAST(coalesce(s.summoney, 0) AS {DEC}) AS amount, s.comment, s.idarticle, r.namearticle AS article_name
  FROM spent_by s LEFT JOIN agents a ON a.idagent = s.agent_at
  LEFT JOIN articles r ON r.idarticle = s.idarticle
  LEFT JOIN (players q JOIN countries n ON n.idcountry = q.idcountry) ON q.membership = s.membership)"""

BONUS_FACT = f"""
granted AS (SELECT * FROM bonuses WHERE datework {RANGE} AND {known('membership')}),""" + \
    agent_at("granted_by", "granted", "timeoper") + f""",
f AS (
  SELECT x.idplayerbonus, x.datework AS gamingday, x.timeoper, x.membership, CAST(x.agent_at AS INT) AS idagent,
    coalesce(a.nameagent, 'NO AGENT') AS agentname, n.namecountry AS citizenshipcountry, x.typeoper, x.idbonusindicator,
    x.idgame, v.namegame AS gamename,
    CAST(coalesce(x.sumbonuses, 0) AS {DEC}) AS sumbonuses, CAST(coalesce(x.costbonuses, 0) AS {DEC}) AS costbonuses,
    x.multiplierloyalty, x.hours, x.handsperhour, x.averbet, x.percentadt,
    CAST((x.multiplierloyalty * x.hours) * (x.handsperhour * x.averbet) AS {DEC}) AS adt, x.comment,
    x.isdeleted IS NOT DISTINCT FROM true AS isdeleted
  FROM granted_by x LEFT JOIN agents a ON a.idagent = x.agent_at LEFT JOIN games v ON v.idgame = x.idgame
  LEFT JOIN (players q JOIN countries n ON n.idcountry = q.idcountry) ON q.membership = x.membership)"""

# ---- visits x sessions: both as intervals; an open end is one microsecond away from the known one
VISITS = f"""
vb AS (
  SELECT gaming_day, membership, CAST(generate_subscripts(v, 1) AS INT) AS visit_no, unnest(v, max_depth := 2)
  FROM (SELECT datework AS gaming_day, membership,
          list({{'time_in': time_in, 'time_out': time_out}} ORDER BY coalesce(time_in, created) NULLS LAST,
               time_out NULLS LAST, created NULLS LAST, time_in NULLS LAST) AS v
        FROM visits WHERE datework {RANGE} AND {known('membership')} GROUP BY ALL)),
played AS (
  SELECT gamingday AS gaming_day, membership, idplayersession, timestart, timefinish, averbet,
    coalesce(timestart, timefinish - INTERVAL 1 MICROSECOND) AS lo,
    coalesce(timefinish, timestart + INTERVAL 1 MICROSECOND) AS hi
  FROM live),
met AS (
  SELECT vb.*, p.* EXCLUDE (gaming_day, membership)
  FROM vb LEFT JOIN played p ON p.gaming_day = vb.gaming_day AND p.membership = vb.membership
    AND p.lo < vb.time_out AND p.hi > vb.time_in)"""
CLOCK = "strftime({0}, '%H:%M:%S.%f')"
REPORT = SESSIONS + "," + VISITS + f""",
report AS (
  SELECT gaming_day, membership, visit_no, {CLOCK.format('time_in')} AS casino_entry_time,
    {CLOCK.format('time_out')} AS casino_exit_time, {CLOCK.format('timestart')} AS session_start,
    {CLOCK.format('timefinish')} AS session_finish, CAST(averbet AS {DEC}) AS averbet
  FROM met)"""

# ---- floor positions: sightings of a position by meters and by session logs
IP_TEXT = "concat_ws('.', {ip} >> 24, ({ip} >> 16) & 255, ({ip} >> 8) & 255, {ip} & 255)"
PLAUSIBLE = "BETWEEN DATE '2000-01-01' AND DATE '2100-01-01'"
ACTIVITY = f"""
seen AS (
  SELECT ipaddr, gamingday AS day, true AS by_meter FROM meter_day
  UNION ALL SELECT ipaddr, gamingday, false FROM player_session_v7),
per_position AS (
  SELECT ipaddr, bool_or(by_meter) AS metered, bool_or(NOT by_meter) AS played,
    min(day) FILTER (WHERE by_meter AND day > DATE '2000-01-01') AS first_seen_meter,
    max(day) FILTER (WHERE by_meter AND day < DATE '2100-01-01') AS last_seen_meter,
    CAST(len(list_distinct(coalesce(list(day) FILTER (WHERE by_meter AND day {PLAUSIBLE}), []))) AS INT) AS total_meter_days,
    min(day) FILTER (WHERE NOT by_meter) AS first_seen_session, max(day) FILTER (WHERE NOT by_meter) AS last_seen_session,
    count(*) FILTER (WHERE NOT by_meter) AS total_sessions
  FROM seen GROUP BY ipaddr),
lm AS (
  SELECT ipaddr, (max({{'day': gamingday, 'timed': generated IS NOT NULL, 'at': generated, 'mac': macaddr}})).mac AS latest_macaddr
  FROM meter_day WHERE gamingday {PLAUSIBLE} GROUP BY ipaddr),
meter AS (SELECT ipaddr, first_seen_meter, last_seen_meter, total_meter_days FROM per_position WHERE metered),
played_at AS (SELECT ipaddr, first_seen_session, last_seen_session, total_sessions FROM per_position WHERE played),
activity AS (
  SELECT ipaddr, first_seen_meter, last_seen_meter, total_meter_days, first_seen_session, last_seen_session, total_sessions,
    latest_macaddr
  FROM per_position LEFT JOIN lm USING (ipaddr))"""

CONFIG = """
ccount AS (
  SELECT ipaddr, CAST(count(*) AS INT) AS cfg_revisions, CAST(len(list_distinct(list(macaddr))) AS INT) AS machine_turnover
  FROM egd_cfg WHERE ipaddr IS NOT NULL GROUP BY ipaddr),
lc AS (
  SELECT c.* FROM egd_cfg c
  WHERE c.ipaddr IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM egd_cfg n WHERE n.ipaddr = c.ipaddr
      AND {'r': n.rev, 'd': n.gamingday, 'g': n.generated, 'm': n.macaddr}
        > {'r': c.rev, 'd': c.gamingday, 'g': c.generated, 'm': c.macaddr}))"""


def positions(as_of: str, name: str = "dim") -> str:
    """CTE of the position dimension as of a day: age of the last sighting decides the status."""
    return f"""
{name} AS (
  SELECT p.ipaddr, {IP_TEXT.format(ip='p.ipaddr')} AS ipaddr_readable,
    CAST((p.ipaddr >> 8) & 255 AS INT) AS floor_zone, CAST(p.ipaddr & 255 AS INT) AS position_in_zone,
    p.latest_macaddr, c.inventorynr, c.manufacturer, c.model, c.game, c.serialnumber, c.coindenom, c.currency, c.gametype,
    c.licensenumber, c.inuse AS cfg_in_use, p.age IS NOT NULL AND p.age <= 7 AS is_active,
    CASE WHEN p.age IS NULL THEN 'Config Only' WHEN p.age > 90 THEN 'Decommissioned'
         WHEN p.age > 7 THEN 'Recently Inactive' ELSE 'Active' END AS position_status,
    least(p.first_seen_meter, p.first_seen_session) AS first_seen,
    greatest(p.last_seen_meter, p.last_seen_session) AS last_seen,
    coalesce(p.total_meter_days, 0) AS total_meter_days, coalesce(p.total_sessions, 0) AS total_sessions,
    k.ipaddr IS NOT NULL AS has_egd_cfg, coalesce(k.cfg_revisions, 0) AS cfg_revisions,
    coalesce(k.machine_turnover, 0) AS machine_turnover
  FROM (SELECT coalesce(a.ipaddr, w.ipaddr) AS ipaddr, a.* EXCLUDE (ipaddr),
          date_diff('day', coalesce(a.last_seen_meter, a.last_seen_session), DATE '{as_of}') AS age
        FROM activity a FULL JOIN (SELECT DISTINCT ipaddr FROM egd_cfg WHERE ipaddr IS NOT NULL) w ON w.ipaddr = a.ipaddr) p
  LEFT JOIN ccount k ON k.ipaddr = p.ipaddr LEFT JOIN lc c ON c.ipaddr = p.ipaddr)"""


# A machine's revisions in order, each with the next one.
HISTORY = f"""
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY macaddr ORDER BY rev NULLS LAST, gamingday NULLS LAST, generated NULLS LAST) AS k
  FROM egd_cfg WHERE ipaddr IS NOT NULL),
history AS (
  SELECT o.ipaddr, {IP_TEXT.format(ip='o.ipaddr')} AS ipaddr_readable, o.macaddr, o.casinoid, o.siteid,
    o.gamingday AS effective_from, coalesce(n.gamingday, DATE '9999-12-31') AS effective_to, n.k IS NULL AS is_current,
    o.inventorynr, o.manufacturer, o.model, o.game, o.serialnumber, o.coindenom, if(n.k IS NULL, 'Current', 'Historical') AS assignment_status, o.rev
  FROM ordered o LEFT JOIN ordered n ON n.macaddr IS NOT DISTINCT FROM o.macaddr AND n.k = o.k + 1)"""

# A reading begins a period unless the machine was read on the position up to
# three days before, with no other machine in between; readings belong to the
# last beginning at or before them.
PERIODS = f"""
daily AS (
  SELECT ipaddr, gamingday, (max({{'timed': generated IS NOT NULL, 'at': generated, 'mac': macaddr}})).mac AS macaddr
  FROM meter_day WHERE gamingday {PLAUSIBLE} GROUP BY ipaddr, gamingday),
begins AS (
  SELECT d.ipaddr, d.gamingday AS period_start FROM daily d
  WHERE NOT EXISTS (
    SELECT 1 FROM daily p WHERE p.ipaddr = d.ipaddr AND p.macaddr = d.macaddr AND p.gamingday BETWEEN d.gamingday - 3
      AND d.gamingday - 1
      AND p.gamingday >= coalesce((SELECT max(o.gamingday) FROM daily o WHERE o.ipaddr = d.ipaddr
                                   AND o.macaddr <> d.macaddr AND o.gamingday < d.gamingday), DATE '0001-01-01'))),
periods AS (
  SELECT d.ipaddr, {IP_TEXT.format(ip='d.ipaddr')} AS ipaddr_readable, d.macaddr, b.period_start,
    max(d.gamingday) AS period_end, count(*) AS days_active,
    CASE WHEN date_diff('day', max(d.gamingday), DATE '2024-01-31') > 90 THEN 'Inactive'
         WHEN date_diff('day', max(d.gamingday), DATE '2024-01-31') > 7 THEN 'Recently Inactive' ELSE 'Active' END
      AS period_status
  FROM daily d ASOF JOIN begins b ON b.ipaddr = d.ipaddr AND d.gamingday >= b.period_start
  GROUP BY d.ipaddr, d.macaddr, b.period_start)"""


def booked(measure: str, alias: str, source_alias: str = "") -> str:
    """Sum of a measure's entries as a fact column."""
    return f"CAST(coalesce(sum({source_alias}amount) FILTER (WHERE measure = '{measure}'), 0) AS {DEC}) AS {alias}"


def ctes(*parts: str) -> str:
    return ",\n".join(p.strip() for p in parts)
