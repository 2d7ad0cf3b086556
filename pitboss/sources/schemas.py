"""Bronze table schemas (the contract every silver/gold operator is written against).

Declared with a compact ``name type`` notation and parsed into ``StructType``s.
Real sources are read with these schemas (no inference) and passed through
``pitboss.sources.sinks.conform``, which adds missing columns as NULL (or a
default) and casts to the declared types.  Upsert keys are listed beside.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "short": T.ShortType(), "string": T.StringType(),
    "date": T.DateType(), "ntz": T.TimestampNTZType(), "ts": T.TimestampType(), "bool": T.BooleanType(),
    "money": T.DecimalType(19, 4), "rate": T.DecimalType(19, 8),
}

# The bronze data model (table -> columns, upsert key).
BRONZE = {
    "person_visits": ("datework date, membership long, time_in ntz, time_out ntz, created ntz", ()),
    "manage_agents_players": ("membership long, idagent int, datechange ntz, created ntz",
                              ("membership", "datechange")),
    "manage_agent_groups": ("idagentgroup long, idagent int, nameagentgroup string, datebegin date, dateend date, "
                            "memoagentgroup string, created ntz, createdby string, modified ntz, modifiedby string, "
                            "row_version long", ("idagentgroup",)),
    "person_players": ("membership long, idagent int, idcountry int, surname string, forename string",
                       ("membership",)),
    "manage_agents": ("idagent int, nameagent string", ("idagent",)),
    "casino_countries": ("idcountry int, namecountry string", ("idcountry",)),
    "promo_bonus_indicators_games": ("idgame int, idslotmanufacturer int, datechange ntz, multiplierloyalty money, "
                                     "handsperhour int, percentadt money",
                                     ("coalesce(idgame, -1)", "coalesce(idslotmanufacturer, -1)", "datechange")),
    "casino_games_ref": ("idgame int, codegame string, namegame string, listorder_game int, idbonussystem int, "
                         "nmbboxes int", ("idgame",)),
    "casino_table_types": ("idtabletype int, codetabletype string, nametabletype string, listorder_tabletype int, "
                           "idgametype int", ("idtabletype",)),
    "casino_table_types_games": ("idtabletype int, idgame int, listorder int", ("idtabletype", "idgame")),
    "casino_tables_ref": ("idtable long, idtabletype int, nametable string, snmbtable string, codetable string, "
                          "isvirtual bool, listorder_table int, idbonusgame int, idbonussystem int, ismarketing bool, "
                          "idcurrency int, mysteryguarantee money, ratemystery money, lowerlimitmystery money, "
                          "upperlimitmystery money, minplayingbet money", ("idtable",)),
    "casino_currency_exch_rates": ("idcasino int, datechange date, idcurrency int, idcurrencyexchrate long, "
                                   "exchrate rate, created ntz, modified ntz, row_version long",
                                   ("idcasino", "datechange", "idcurrency")),
    "cashdesk_transactions": ("idoper long, datework date, timeoper ntz, membership long, idaccount int, "
                              "directionoper int, totalmoneyue money, chipsue money, isdeleted bool, "
                              "iscalculatedindrop bool, idarticle int, comment string", ("idoper",)),
    "cashdesk_articles": ("idarticle int, namearticle string", ("idarticle",)),
    "casino_transactions_calculated": ("idoper long, deposit money", ("idoper",)),
    "manage_player_sessions": ("idplayerstracking long, timestart ntz, idplayersession long, timefinish ntz, "
                               "idtable int, idgame int, idslot int, realdrop money, chipsin money, chipsout money, "
                               "handhold money, cashout money, averbet money, isdeleted bool",
                               ("idplayerstracking", "timestart")),
    "casino_players_tracking": ("idplayerstracking long, datework date, membership long", ("idplayerstracking",)),
    "drgt_sessions": ("playerid long, ipaddr long, id_session long, gamingday date, starttimelocal ntz, "
                      "endtimelocal ntz, totalbet money, cashbet money, totalout money, win money, nwl money, "
                      "billdrop money, gamesplayed money", ("playerid", "id_session")),
    "casino_transaction_money": ("idoper long, idmoney int, summoney money", ("idoper", "idmoney")),
    "manage_player_session_details": ("idplayersessiondetail long, idplayersession long",
                                      ("idplayersessiondetail",)),
    "manage_player_session_detail_chips": ("idplayersessiondetail long, idchip int, qntchips money",
                                           ("idplayersessiondetail", "idchip")),
    "casino_chips": ("idchip int, valuechip money", ("idchip",)),
    "promo_player_bonuses": ("idplayerbonus long, typeoper int, datework date, timeoper ntz, membership long, "
                             "idbonusindicator int, idgame int, sumbonuses money, costbonuses money, "
                             "multiplierloyalty money, hours money, handsperhour int, averbet money, "
                             "percentadt money, isdeleted bool, comment string", ("idplayerbonus",)),
    "promo_bonus_indicators": ("idbonusindicator int, codebonusindicator string, namebonusindicator string",
                               ("idbonusindicator",)),
    "sm_egd_cfg": ("generated ntz, gamingday date, casinoid string, siteid string, ipaddr int, macaddr long, "
                   "smibip int, rev long, inventorynr string, manufacturer string, model string, game string, "
                   "user1 string, user2 string, coindenom money, currency string, licensenumber string, "
                   "serialnumber string, user3 string, user4 string, gametype string, inuse bool, lastchanged ntz, "
                   "lastchangedby string",
                   ("casinoid", "siteid", "macaddr", "smibip", "rev")),
    "meter_day": ("ipaddr int, macaddr long, gamingday date, generated ntz", ()),
    "player_session_v7": ("ipaddr int, gamingday date", ()),
}

# The bronze shape each fixture adapter produces (adapter name -> bronze table).
ADAPTER_TABLE = {
    "visits": "person_visits", "agents_players": "manage_agents_players", "agent_groups": "manage_agent_groups",
    "players": "person_players", "agents": "manage_agents", "countries": "casino_countries",
    "table_types": "casino_table_types", "table_type_games": "casino_table_types_games",
    "tables_ref": "casino_tables_ref", "games": "casino_games_ref", "fx_rates": "casino_currency_exch_rates", "cashdesk_tx": "cashdesk_transactions",
    "articles": "cashdesk_articles", "tx_calculated": "casino_transactions_calculated",
    "player_sessions": "manage_player_sessions", "players_tracking": "casino_players_tracking",
    "drgt_sessions": "drgt_sessions", "tx_money": "casino_transaction_money",
    "session_details": "manage_player_session_details", "session_detail_chips": "manage_player_session_detail_chips",
    "chips": "casino_chips", "bonuses": "promo_player_bonuses", "bonus_indicators": "promo_bonus_indicators",
    "indicator_games": "promo_bonus_indicators_games", "egd_cfg": "sm_egd_cfg", "meter_day": "meter_day", "player_session_v7": "player_session_v7",
}


def schema(table: str) -> T.StructType:
    cols, _ = BRONZE[table]
    fields = []
    for part in cols.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


def key(table: str) -> tuple[str, ...]:
    return BRONZE[table][1]
