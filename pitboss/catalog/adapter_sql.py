"""The fixture adapters as DuckDB SQL, used only by the independent SQL check.

Each entry is the body of one CTE over the raw tables.  ``with_adapters``
prefixes a query with the CTEs it names (and their dependencies).
"""

from __future__ import annotations

F_DAY = "DATE '2024-01-05'"
T_DAY = "DATE '2024-01-20'"

ADAPTERS: dict[str, str] = {
    "visits": """
SELECT CAST(ts AS DATE) AS datework, user_id AS membership,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS time_in,
       CASE WHEN event_id % 40 = 0 THEN NULL ELSE ts + INTERVAL '1' MINUTE * CAST(240 + event_id % 240 AS INT) END AS time_out,
       ts AS created
FROM events WHERE event_type = 'signup'""",
    "drgt": """
SELECT user_id AS playerid, 167837953 + event_id % 45 AS ipaddr, event_id AS id_session,
       CAST(ts AS DATE) AS gamingday, ts AS starttimelocal,
       ts + INTERVAL '1' MINUTE * CAST(event_id % 90 AS INT) AS endtimelocal,
       CAST(CAST(value AS DECIMAL(19,4)) * 100 AS DECIMAL(19,4)) AS totalbet,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(CAST(value AS DECIMAL(19,4)) * 90 AS DECIMAL(19,4)) END AS cashbet,
       CAST(CAST(value AS DECIMAL(19,4)) * 80 AS DECIMAL(19,4)) AS totalout,
       CAST(CAST(value AS DECIMAL(19,4)) * 20 AS DECIMAL(19,4)) AS win,
       CAST(CAST(value AS DECIMAL(19,4)) * -20 AS DECIMAL(19,4)) AS nwl,
       CAST(CAST(value AS DECIMAL(19,4)) * 50 AS DECIMAL(19,4)) AS billdrop,
       CAST(event_id % 400 AS DECIMAL(19,4)) AS gamesplayed
FROM events WHERE event_type = 'error'""",
    "players_tracking": """
SELECT event_id AS idplayerstracking, CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS datework,
       user_id AS membership
FROM events WHERE event_type = 'view'""",
    "player_sessions": """
SELECT event_id AS idplayerstracking, CASE WHEN event_id % 61 = 0 THEN NULL ELSE ts END AS timestart,
       event_id AS idplayersession,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts + INTERVAL '1' MINUTE * CAST(event_id % 180 - 5 AS INT) END AS timefinish,
       CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 13 AS INT) END AS idtable,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END AS idgame,
       CAST(NULL AS INT) AS idslot,
       CAST(value AS DECIMAL(19,4)) AS realdrop, CAST(value AS DECIMAL(19,4)) AS chipsin,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(value AS DECIMAL(19,4)) END AS chipsout,
       CAST(value AS DECIMAL(19,4)) AS handhold, CAST(value AS DECIMAL(19,4)) AS cashout,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(value AS DECIMAL(19,4)) END AS averbet,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 23 = 1 END AS isdeleted
FROM events WHERE event_type = 'view'""",
    "cashdesk_tx": """
SELECT event_id AS idoper, CAST(ts AS DATE) AS datework, ts AS timeoper, user_id AS membership,
       CASE CAST(event_id % 10 AS INT) WHEN 0 THEN 802 WHEN 1 THEN 803 WHEN 2 THEN 641 WHEN 3 THEN 153 WHEN 4 THEN 151
            WHEN 5 THEN 154 WHEN 6 THEN 703 ELSE 121 END AS idaccount,
       CASE WHEN event_type = 'click' THEN -1 ELSE 1 END AS directionoper,
       CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'click' THEN CAST(-value AS DECIMAL(19,4)) ELSE CAST(value AS DECIMAL(19,4)) END AS totalmoneyue,
       CAST(value AS DECIMAL(19,4)) AS chipsue,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 19 = 1 END AS isdeleted,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE event_id % 41 <> 1 END AS iscalculatedindrop,
       CAST(event_id % 14 AS INT) AS idarticle,
       CASE CAST(event_id % 7 AS INT) WHEN 0 THEN 'FLIGHT out and back' WHEN 1 THEN 'air tiket' WHEN 2 THEN 'hotel 2 nights'
            WHEN 3 THEN 'Discaunt 10pct' WHEN 4 THEN 'Air Ticket + Hotel' WHEN 5 THEN 'taxi' ELSE NULL END AS comment
FROM events WHERE event_type IN ('click', 'purchase')""",
    "tx_calculated": """
SELECT event_id AS idoper, CASE WHEN event_id % 4 = 1 THEN CAST(-value AS DECIMAL(19,4)) ELSE CAST(value AS DECIMAL(19,4)) END AS deposit
FROM events WHERE event_type IN ('click', 'purchase') AND event_id % 10 = 1""",
    "tx_money": """
SELECT event_id AS idoper, 1 AS idmoney, CAST(value AS DECIMAL(19,4)) AS summoney FROM events WHERE event_type IN ('click','purchase') AND event_id % 13 <> 0
UNION ALL
SELECT event_id, 2, CAST(-1.5 AS DECIMAL(19,4)) FROM events WHERE event_type IN ('click','purchase') AND event_id % 3 = 0""",
    "players": """
SELECT c_custkey AS membership, CAST(c_custkey % 10 AS INT) AS idagent,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS idcountry,
       c_name AS surname, CASE WHEN c_custkey % 7 = 0 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END AS forename
FROM customer""",
    "agents": """
SELECT CAST(s_suppkey AS INT) AS idagent, CASE CAST(s_suppkey AS INT) WHEN 3 THEN '' WHEN 4 THEN 'NO AGENT' ELSE s_name END AS nameagent
FROM supplier WHERE s_suppkey % 10 <> 9""",
    "countries": "SELECT n_nationkey AS idcountry, n_name AS namecountry FROM nation",
    "games": """
SELECT n_nationkey AS idgame, 'G' || CAST(n_nationkey AS VARCHAR) AS codegame, n_name AS namegame,
       n_nationkey % 4 AS listorder_game, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey % 3 END AS idbonussystem,
       n_nationkey % 7 AS nmbboxes
FROM nation WHERE n_nationkey % 9 <> 8""",
    "table_types": """
SELECT r_regionkey AS idtabletype, 'T' || CAST(r_regionkey AS VARCHAR) AS codetabletype, r_name AS nametabletype,
       10 - r_regionkey AS listorder_tabletype, CASE WHEN r_regionkey = 2 THEN NULL ELSE r_regionkey % 3 END AS idgametype
FROM region""",
    "table_type_games": "SELECT n_regionkey AS idtabletype, n_nationkey AS idgame, n_nationkey % 5 AS listorder FROM nation",
    "tables_ref": """
SELECT s_suppkey AS idtable, s_nationkey % 5 AS idtabletype, s_name AS nametable, CAST(s_suppkey % 100 AS VARCHAR) AS snmbtable,
       'TB' || CAST(s_suppkey AS VARCHAR) AS codetable, s_suppkey % 9 = 0 AS isvirtual,
       CAST(s_suppkey % 50 AS INT) AS listorder_table,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey % 6 AS INT) END AS idbonusgame,
       CAST(s_suppkey % 3 AS INT) AS idbonussystem, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey % 2 = 0 END AS ismarketing,
       s_nationkey % 5 AS idcurrency, CAST(s_acctbal AS DECIMAL(19,4)) AS mysteryguarantee,
       CAST((s_suppkey % 50) * 0.01 AS DECIMAL(19,4)) AS ratemystery, CAST(0 AS DECIMAL(19,4)) AS lowerlimitmystery,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_suppkey % 50 AS DECIMAL(19,4)) END AS upperlimitmystery,
       CAST(5 AS DECIMAL(19,4)) AS minplayingbet
FROM supplier""",
    "agents_players_src": """
SELECT o_custkey AS membership, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 10 AS INT) END AS idagent,
       o_orderdate + INTERVAL '26' YEAR AS datechange, o_orderdate + INTERVAL '26' YEAR AS created, o_orderkey AS seq
FROM orders""",
    "agents_players": """
SELECT DISTINCT ON (membership, datechange) membership, idagent, datechange, created
FROM agents_players_src ORDER BY membership, datechange, seq DESC""",
    "agent_groups": """
SELECT s.s_suppkey * 10 + r.r_regionkey AS idagentgroup, CAST(s.s_suppkey AS INT) AS idagent,
       'Group ' || CAST(r.r_regionkey AS VARCHAR) AS nameagentgroup,
       CASE WHEN r.r_regionkey = 1 THEN NULL ELSE 'memo ' || CAST(s.s_suppkey AS VARCHAR) END AS memoagentgroup,
       s.s_suppkey + r.r_regionkey AS row_version,
       DATE '2024-01-01' + CAST(r.r_regionkey * 6 AS INT) AS datebegin,
       CASE WHEN r.r_regionkey = 4 THEN NULL ELSE DATE '2024-01-01' + CAST(r.r_regionkey * 6 + 7 AS INT) END AS dateend,
       TIMESTAMP '2024-01-01 00:00:00' AS modified
FROM supplier s CROSS JOIN region r WHERE s.s_suppkey % 10 <> 7""",
    "articles": "SELECT n_nationkey AS idarticle, n_name AS namearticle FROM nation WHERE n_nationkey % 14 < 12",
    "bonus_indicators": """
SELECT r_regionkey AS idbonusindicator, 'C' || CAST(r_regionkey AS VARCHAR(10)) AS codebonusindicator, r_name AS namebonusindicator FROM region""",
    "fx_rates_src": """
SELECT 1 AS idcasino, CAST(o_orderdate + INTERVAL '26' YEAR AS DATE) AS datechange, CAST(o_custkey % 5 AS INT) AS idcurrency,
       CAST(1 + (o_orderkey % 1000) * 0.0001 AS DECIMAL(19,8)) AS exchrate, o_orderkey AS row_version,
       o_orderkey + 7 AS idcurrencyexchrate, o_orderdate AS created,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderdate END AS modified
FROM orders""",
    "fx_rates": """
SELECT DISTINCT ON (idcasino, datechange, idcurrency) * FROM fx_rates_src
ORDER BY idcasino, datechange, idcurrency, row_version DESC""",
    "chips": "SELECT CAST(p_partkey AS INT) AS idchip, CAST(p_retailprice AS DECIMAL(19,4)) AS valuechip FROM part WHERE p_partkey % 55 < 50",
    "session_details": """
SELECT event_id * 10 + r_regionkey AS idplayersessiondetail, event_id AS idplayersession
FROM events CROSS JOIN region WHERE event_type = 'view' AND r_regionkey < 2""",
    "session_detail_chips": """
SELECT event_id * 10 + r_regionkey AS idplayersessiondetail, CAST((event_id + r_regionkey) % 55 AS INT) AS idchip,
       CAST(event_id % 7 - 3 AS DECIMAL(19,4)) AS qntchips
FROM events CROSS JOIN region WHERE event_type = 'view' AND r_regionkey < 2""",
    "bonuses": """
SELECT event_id AS idplayerbonus, CASE WHEN event_id % 9 = 0 THEN -1 ELSE 1 END AS typeoper,
       CAST(ts AS DATE) AS datework, ts AS timeoper, user_id AS membership, CAST(event_id % 9 AS INT) AS idbonusindicator,
       CAST(event_id % 10 AS INT) AS idgame, CAST(value AS DECIMAL(19,4)) AS sumbonuses,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE CAST(value AS DECIMAL(19,4)) END AS costbonuses,
       CAST((266 + event_id % 300) * 0.0001 AS DECIMAL(19,4)) AS multiplierloyalty,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE CAST((event_id % 50000) * 0.0001 AS DECIMAL(19,4)) END AS hours,
       CASE WHEN event_id % 3 = 0 THEN 30 ELSE 60 END AS handsperhour,
       CAST(CAST(value AS DECIMAL(19,4)) + CAST((event_id % 97) * 0.0001 AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS averbet,
       CAST(0.2 AS DECIMAL(19,4)) AS percentadt, event_id % 37 = 0 AS isdeleted,
       CAST(NULL AS VARCHAR) AS comment
FROM events WHERE event_type = 'purchase'""",
    "indicator_games": """
SELECT CAST(nullif(o_orderkey % 10, 0) AS INT) AS idgame, CAST(nullif(o_custkey % 4, 0) AS INT) AS idslotmanufacturer,
       CAST(o_orderdate AS TIMESTAMP) AS datechange, CAST(o_orderkey % 300 AS DECIMAL(19,4)) AS multiplierloyalty,
       CAST(o_orderkey % 90 AS INT) AS handsperhour, CAST(o_orderkey % 50 AS DECIMAL(19,4)) AS percentadt
FROM orders""",
    "egd_cfg": """
SELECT o_orderdate AS generated, CAST(o_orderdate AS DATE) AS gamingday, 'C001' AS casinoid, 'S001' AS siteid,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(167837953 + o_orderkey % 40 AS INT) END AS ipaddr,
       1000 + o_custkey % 20 AS macaddr, 1 AS smibip,
       row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) AS rev,
       'INV' || CAST(o_custkey % 20 AS VARCHAR(10)) AS inventorynr, o_orderpriority AS manufacturer, o_orderstatus AS model,
       'Game ' || CAST(o_orderkey % 12 AS VARCHAR(10)) AS game,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'U' || CAST(o_orderkey % 5 AS VARCHAR(10)) END AS user1, CAST(NULL AS VARCHAR) AS user2,
       CAST((o_orderkey % 4 + 1) * 0.01 AS DECIMAL(19,4)) AS coindenom, if(o_orderkey % 2 = 0, 'EUR', 'CZK') AS currency,
       'L' || CAST(o_orderkey % 1000 AS VARCHAR(10)) AS licensenumber,
       CASE WHEN o_orderkey % 13 <> 0 THEN 'SN' || CAST(o_custkey % 20 AS VARCHAR(10)) END AS serialnumber,
       o_orderpriority AS user3, CAST(NULL AS VARCHAR) AS user4, if(o_orderkey % 3 = 0, 'VIDEO', 'REEL') AS gametype,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 9 <> 0 END AS inuse, o_orderdate AS lastchanged,
       'user' || CAST(o_orderkey % 7 AS VARCHAR(10)) AS lastchangedby
FROM orders""",
    "meter_day": """
SELECT CAST(167837953 + event_id % 45 AS INT) AS ipaddr, 1000 + (event_id % 45) * 2 + CASE WHEN event_id % 45 % 3 = 0 AND CAST(ts AS DATE) > DATE '2024-01-12' THEN 1 ELSE 0 END AS macaddr,
       CASE WHEN event_id % 401 = 0 THEN DATE '1900-01-01' WHEN event_id % 409 = 0 THEN DATE '2155-01-01' ELSE CAST(ts AS DATE) END AS gamingday,
       ts AS generated
FROM events WHERE event_id % 5 <> 0 OR CAST(ts AS DATE) <= DATE '2024-01-10'""",
    "player_session_v7": """
SELECT CAST(167837953 + 30 + event_id % 20 AS INT) AS ipaddr, CAST(ts AS DATE) AS gamingday
FROM events WHERE event_type = 'view'""",
}

DEPENDS = {
    "agents_players": ["agents_players_src"],
    "fx_rates": ["fx_rates_src"],
}


def with_adapters(names: list[str] | tuple[str, ...], body: str, extra_ctes: str = "",
                  recursive: bool = False) -> str:
    """``WITH <adapters...> [, extra] <body>`` -- ``body`` starts with SELECT."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({ADAPTERS[n].strip()})" for n in ordered]
    if extra_ctes.strip():
        ctes.append(extra_ctes.strip())
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + body.strip()
