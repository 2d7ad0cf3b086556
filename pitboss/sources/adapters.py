"""Bronze-shaped inputs derived from the raw parquet tables.

Every silver/gold operator of the library is written against the bronze
shapes (``pitboss.sources.schemas``).  For tests, the bench and the SQL check
those shapes are derived from the raw tables by the functions below; each is
one projection/filter over one scan, so Catalyst prunes columns and pushes the
filters into the parquet reader.  Money columns are DOUBLE in the raw tables
and are cast to DECIMAL(19,4) before any arithmetic.

Fixed fixture values (they define the test inputs and must stay as written):
  parameter range F..T = 2024-01-05..2024-01-20
  floor base address 167837953 (= 10.1.1.1)
  sentinel dates 1900-01-01 / 2155-01-01 for the plausible-date guard
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

DEC = "decimal(19,4)"
FROM_DAY = dt.date(2024, 1, 5)
TO_DAY = dt.date(2024, 1, 20)
BASE_IP = 167837953


def _dec(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(DEC)


def _minutes_after(ts: str, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), F.col(ts))


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _events(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    return read_table(spark, sf, "events", *cols)


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """person_visits: sign-ups play the check-in role; some in/out times are null."""
    e = _events(spark, sf, "event_id", "ts", "user_id", "event_type").filter(F.col("event_type") == "signup")
    eid = F.col("event_id")
    return e.select(
        F.to_date("ts").alias("datework"),
        F.col("user_id").alias("membership"),
        _null_when(eid % 50 == 0, F.col("ts")).alias("time_in"),
        _null_when(eid % 40 == 0, _minutes_after("ts", 240 + eid % 240)).alias("time_out"),
        F.col("ts").alias("created"),
    )


def drgt_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Slot sessions (amounts in hundredths)."""
    e = _events(spark, sf, "event_id", "ts", "user_id", "event_type", "value").filter(F.col("event_type") == "error")
    eid, v = F.col("event_id"), _dec("value")
    return e.select(
        F.col("user_id").alias("playerid"),
        (F.lit(BASE_IP) + eid % 45).alias("ipaddr"),
        eid.alias("id_session"),
        F.to_date("ts").alias("gamingday"),
        F.col("ts").alias("starttimelocal"),
        _minutes_after("ts", eid % 90).alias("endtimelocal"),
        (v * 100).cast(DEC).alias("totalbet"),
        _null_when(eid % 6 == 0, (v * 90).cast(DEC)).alias("cashbet"),
        (v * 80).cast(DEC).alias("totalout"),
        (v * 20).cast(DEC).alias("win"),
        (v * -20).cast(DEC).alias("nwl"),
        (v * 50).cast(DEC).alias("billdrop"),
        (eid % 400).cast(DEC).alias("gamesplayed"),
    )


def players_tracking(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf, "event_id", "ts", "user_id", "event_type").filter(F.col("event_type") == "view")
    eid = F.col("event_id")
    return e.select(
        eid.alias("idplayerstracking"),
        _null_when(eid % 59 == 0, F.to_date("ts")).alias("datework"),
        F.col("user_id").alias("membership"),
    )


def player_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Table sessions: null start, null finish, finish < start and soft-deletes occur."""
    e = _events(spark, sf, "event_id", "ts", "event_type", "value").filter(F.col("event_type") == "view")
    eid, v = F.col("event_id"), _dec("value")
    return e.select(
        eid.alias("idplayerstracking"),
        _null_when(eid % 61 == 0, F.col("ts")).alias("timestart"),
        eid.alias("idplayersession"),
        _null_when(eid % 17 == 0, _minutes_after("ts", eid % 180 - 5)).alias("timefinish"),
        _null_when(eid % 31 == 0, (eid % 13).cast("int")).alias("idtable"),
        _null_when(eid % 29 == 0, (eid % 9).cast("int")).alias("idgame"),
        F.lit(None).cast("int").alias("idslot"),
        v.alias("realdrop"),
        v.alias("chipsin"),
        _null_when(eid % 4 == 0, v).alias("chipsout"),
        v.alias("handhold"),
        v.alias("cashout"),
        _null_when(eid % 5 == 0, v).alias("averbet"),
        _null_when(eid % 3 == 0, eid % 23 == 1).alias("isdeleted"),
    )


def cashdesk_tx(spark: SparkSession, sf: str) -> DataFrame:
    """Cashdesk operations: click = money out, purchase = money in."""
    e = _events(spark, sf, "event_id", "ts", "user_id", "event_type", "value").filter(
        F.col("event_type").isin("click", "purchase"))
    eid, v = F.col("event_id"), F.col("value")
    is_out = F.col("event_type") == "click"
    account = (F.when(eid % 10 == 0, 802).when(eid % 10 == 1, 803).when(eid % 10 == 2, 641)
               .when(eid % 10 == 3, 153).when(eid % 10 == 4, 151).when(eid % 10 == 5, 154)
               .when(eid % 10 == 6, 703).otherwise(121))
    comment = (F.when(eid % 7 == 0, "FLIGHT out and back").when(eid % 7 == 1, "air tiket")
               .when(eid % 7 == 2, "hotel 2 nights").when(eid % 7 == 3, "Discaunt 10pct")
               .when(eid % 7 == 4, "Air Ticket + Hotel").when(eid % 7 == 5, "taxi"))
    return e.select(
        eid.alias("idoper"),
        F.to_date("ts").alias("datework"),
        F.col("ts").alias("timeoper"),
        F.col("user_id").alias("membership"),
        account.cast("int").alias("idaccount"),
        F.when(is_out, -1).otherwise(1).alias("directionoper"),
        F.when(eid % 97 == 0, F.lit(None).cast(DEC))
        .when(is_out, (-v).cast(DEC)).otherwise(v.cast(DEC)).alias("totalmoneyue"),
        v.cast(DEC).alias("chipsue"),
        _null_when(eid % 3 == 0, eid % 19 == 1).alias("isdeleted"),
        _null_when(eid % 83 == 0, eid % 41 != 1).alias("iscalculatedindrop"),
        (eid % 14).cast("int").alias("idarticle"),
        comment.alias("comment"),
    )


def tx_calculated(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf, "event_id", "event_type", "value").filter(
        F.col("event_type").isin("click", "purchase") & (F.col("event_id") % 10 == 1))
    eid, v = F.col("event_id"), F.col("value")
    return e.select(eid.alias("idoper"),
                    F.when(eid % 4 == 1, (-v).cast(DEC)).otherwise(v.cast(DEC)).alias("deposit"))


def tx_money(spark: SparkSession, sf: str) -> DataFrame:
    """One or two money rows per operation; some operations have none."""
    e = _events(spark, sf, "event_id", "event_type", "value").filter(F.col("event_type").isin("click", "purchase"))
    eid = F.col("event_id")
    first = e.filter(eid % 13 != 0).select(eid.alias("idoper"), F.lit(1).alias("idmoney"),
                                           _dec("value").alias("summoney"))
    second = e.filter(eid % 3 == 0).select(eid.alias("idoper"), F.lit(2).alias("idmoney"),
                                           F.lit(-1.5).cast(DEC).alias("summoney"))
    return first.unionByName(second)


def players(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        k.alias("membership"),
        (k % 10).cast("int").alias("idagent"),
        _null_when(k % 13 == 0, F.col("c_nationkey")).alias("idcountry"),
        F.col("c_name").alias("surname"),
        F.when(k % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
        .alias("forename"),
    )


def agents(spark: SparkSession, sf: str) -> DataFrame:
    """Agents 1..8; 3 has an empty name, 4 the literal 'NO AGENT'."""
    s = read_table(spark, sf, "supplier", "s_suppkey", "s_name").filter(F.col("s_suppkey") % 10 != 9)
    k = F.col("s_suppkey").cast("int")
    return s.select(k.alias("idagent"),
                    F.when(k == 3, "").when(k == 4, "NO AGENT").otherwise(F.col("s_name")).alias("nameagent"))


def countries(spark: SparkSession, sf: str) -> DataFrame:
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name")
    return n.select(F.col("n_nationkey").alias("idcountry"), F.col("n_name").alias("namecountry"))


def games(spark: SparkSession, sf: str) -> DataFrame:
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name").filter(F.col("n_nationkey") % 9 != 8)
    k = F.col("n_nationkey")
    return n.select(k.alias("idgame"), F.concat(F.lit("G"), k.cast("string")).alias("codegame"),
                    F.col("n_name").alias("namegame"), (k % 4).alias("listorder_game"),
                    _null_when(k % 5 == 0, k % 3).alias("idbonussystem"), (k % 7).alias("nmbboxes"))


def table_types(spark: SparkSession, sf: str) -> DataFrame:
    r = read_table(spark, sf, "region", "r_regionkey", "r_name")
    k = F.col("r_regionkey")
    return r.select(k.alias("idtabletype"), F.concat(F.lit("T"), k.cast("string")).alias("codetabletype"),
                    F.col("r_name").alias("nametabletype"), (F.lit(10) - k).alias("listorder_tabletype"),
                    _null_when(k == 2, k % 3).alias("idgametype"))


def table_type_games(spark: SparkSession, sf: str) -> DataFrame:
    n = read_table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    k = F.col("n_nationkey")
    return n.select(F.col("n_regionkey").alias("idtabletype"), k.alias("idgame"), (k % 5).alias("listorder"))


def tables_ref(spark: SparkSession, sf: str) -> DataFrame:
    s = read_table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    k, small = F.col("s_suppkey"), (F.col("s_suppkey") % 50).cast("int")
    return s.select(
        k.alias("idtable"), (F.col("s_nationkey") % 5).alias("idtabletype"), F.col("s_name").alias("nametable"),
        (k % 100).cast("string").alias("snmbtable"), F.concat(F.lit("TB"), k.cast("string")).alias("codetable"),
        (k % 9 == 0).alias("isvirtual"), small.alias("listorder_table"),
        _null_when(k % 4 == 0, (k % 6).cast("int")).alias("idbonusgame"), (k % 3).cast("int").alias("idbonussystem"),
        _null_when(k % 5 == 0, k % 2 == 0).alias("ismarketing"), (F.col("s_nationkey") % 5).alias("idcurrency"),
        _dec("s_acctbal").alias("mysteryguarantee"), (small * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(19,4)")
        .alias("ratemystery"), F.lit(0).cast("decimal(19,4)").alias("lowerlimitmystery"),
        _null_when(k % 7 == 0, small.cast("decimal(19,4)")).alias("upperlimitmystery"),
        F.lit(5).cast("decimal(19,4)").alias("minplayingbet"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name").filter(F.col("n_nationkey") % 14 < 12)
    return n.select(F.col("n_nationkey").alias("idarticle"), F.col("n_name").alias("namearticle"))


def bonus_indicators(spark: SparkSession, sf: str) -> DataFrame:
    r = read_table(spark, sf, "region", "r_regionkey", "r_name")
    return r.select(F.col("r_regionkey").alias("idbonusindicator"),
                    F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("codebonusindicator"),
                    F.col("r_name").alias("namebonusindicator"))


def agents_players_src(spark: SparkSession, sf: str) -> DataFrame:
    """Agent history batch; (membership, datechange) repeats, ``seq`` orders the copies."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    moved = F.col("o_orderdate") + F.expr("INTERVAL '26' YEAR")
    return o.select(
        F.col("o_custkey").alias("membership"),
        _null_when(k % 11 == 0, (k % 10).cast("int")).alias("idagent"),
        moved.alias("datechange"),
        moved.alias("created"),
        k.alias("seq"),
    )


def agent_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Five overlapping date ranges per agent, the last one open-ended.

    The five ranges are indexed by the region keys 0..4; they are generated per
    supplier row with ``explode`` (a fixed fan-out of five), not a join.
    """
    s = read_table(spark, sf, "supplier", "s_suppkey").filter(F.col("s_suppkey") % 10 != 7)
    s = s.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("r"))
    start = F.lit(dt.date(2024, 1, 1))
    return s.select(
        (F.col("s_suppkey") * 10 + F.col("r")).alias("idagentgroup"),
        F.col("s_suppkey").cast("int").alias("idagent"),
        F.concat(F.lit("Group "), F.col("r").cast("string")).alias("nameagentgroup"),
        F.date_add(start, F.col("r") * 6).alias("datebegin"),
        _null_when(F.col("r") == 4, F.date_add(start, F.col("r") * 6 + 7)).alias("dateend"),
        _null_when(F.col("r") == 1, F.concat(F.lit("memo "), F.col("s_suppkey").cast("string"))).alias("memoagentgroup"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("modified"),
        (F.col("s_suppkey") + F.col("r")).alias("row_version"),
    )


def fx_rates_src(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        F.lit(1).alias("idcasino"),
        F.to_date(F.col("o_orderdate") + F.expr("INTERVAL '26' YEAR")).alias("datechange"),
        (F.col("o_custkey") % 5).cast("int").alias("idcurrency"),
        (k + 7).alias("idcurrencyexchrate"),
        (F.lit(1) + (k % 1000) * F.lit(0.0001).cast("decimal(4,4)")).cast("decimal(19,8)").alias("exchrate"),
        k.alias("row_version"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created"),
        _null_when(k % 6 == 0, F.col("o_orderdate").cast("timestamp_ntz")).alias("modified"),
    )


def chips(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part", "p_partkey", "p_retailprice").filter(F.col("p_partkey") % 55 < 50)
    return p.select(F.col("p_partkey").cast("int").alias("idchip"), _dec("p_retailprice").alias("valuechip"))


def _view_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Two detail rows per table-session event (region keys 0 and 1 of the fixture)."""
    e = _events(spark, sf, "event_id", "event_type").filter(F.col("event_type") == "view")
    return e.select("event_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("r"))


def session_details(spark: SparkSession, sf: str) -> DataFrame:
    e = _view_pairs(spark, sf)
    return e.select((F.col("event_id") * 10 + F.col("r")).alias("idplayersessiondetail"),
                    F.col("event_id").alias("idplayersession"))


def session_detail_chips(spark: SparkSession, sf: str) -> DataFrame:
    """Chip ids 50..54 have no chip row, so the inner join drops them."""
    e = _view_pairs(spark, sf)
    return e.select((F.col("event_id") * 10 + F.col("r")).alias("idplayersessiondetail"),
                    ((F.col("event_id") + F.col("r")) % 55).cast("int").alias("idchip"),
                    (F.col("event_id") % 7 - 3).cast(DEC).alias("qntchips"))


def bonuses(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf, "event_id", "ts", "user_id", "event_type", "value").filter(F.col("event_type") == "purchase")
    eid = F.col("event_id")
    d4 = F.lit(0.0001).cast("decimal(4,4)")
    return e.select(
        eid.alias("idplayerbonus"),
        F.when(eid % 9 == 0, -1).otherwise(1).alias("typeoper"),
        F.to_date("ts").alias("datework"),
        F.col("ts").alias("timeoper"),
        F.col("user_id").alias("membership"),
        (eid % 9).cast("int").alias("idbonusindicator"),
        (eid % 10).cast("int").alias("idgame"),
        _dec("value").alias("sumbonuses"),
        _null_when(eid % 2 == 0, _dec("value")).alias("costbonuses"),
        ((266 + eid % 300) * d4).cast(DEC).alias("multiplierloyalty"),
        _null_when(eid % 12 == 0, ((eid % 50000) * d4).cast(DEC)).alias("hours"),
        F.when(eid % 3 == 0, 30).otherwise(60).alias("handsperhour"),
        (_dec("value") + ((eid % 97) * d4).cast(DEC)).cast(DEC).alias("averbet"),
        F.lit(0.2).cast(DEC).alias("percentadt"),
        (eid % 37 == 0).alias("isdeleted"),
        F.lit(None).cast("string").alias("comment"),
    )


def indicator_games(spark: SparkSession, sf: str) -> DataFrame:
    """Bonus parameters by game and manufacturer; either may be NULL (any)."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select(F.nullif(k % 10, F.lit(0)).cast("int").alias("idgame"),
                    F.nullif(F.col("o_custkey") % 4, F.lit(0)).cast("int").alias("idslotmanufacturer"),
                    F.col("o_orderdate").cast("timestamp_ntz").alias("datechange"),
                    (k % 300).cast(DEC).alias("multiplierloyalty"), (k % 90).cast("int").alias("handsperhour"),
                    (k % 50).cast(DEC).alias("percentadt"))


def egd_cfg(spark: SparkSession, sf: str) -> DataFrame:
    """Floor configuration: 20 machines rotating over 40 positions.

    ``rev`` is the revision number per machine (order of o_orderkey); it is a
    running count per machine computed with the skew-safe chunked row number,
    because one machine holds 1/20 of all rows.
    """
    from ..operators.scan import chunked_row_number

    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    k = F.col("o_orderkey")
    base = o.select(
        F.col("o_orderdate").alias("generated"),
        F.to_date("o_orderdate").alias("gamingday"),
        F.lit("C001").alias("casinoid"),
        F.lit("S001").alias("siteid"),
        _null_when(k % 37 == 0, (F.lit(BASE_IP) + k % 40).cast("int")).alias("ipaddr"),
        (1000 + F.col("o_custkey") % 20).alias("macaddr"),
        F.lit(1).alias("smibip"),
        F.concat(F.lit("INV"), (F.col("o_custkey") % 20).cast("string")).alias("inventorynr"),
        F.col("o_orderpriority").alias("manufacturer"),
        F.col("o_orderstatus").alias("model"),
        F.concat(F.lit("Game "), (k % 12).cast("string")).alias("game"),
        _null_when(k % 3 == 0, F.concat(F.lit("U"), (k % 5).cast("string"))).alias("user1"),
        F.lit(None).cast("string").alias("user2"),
        ((k % 4 + 1) * F.lit(0.01).cast("decimal(3,2)")).cast(DEC).alias("coindenom"),
        F.when(k % 2 == 0, F.lit("EUR")).otherwise(F.lit("CZK")).alias("currency"),
        F.concat(F.lit("L"), (k % 1000).cast("string")).alias("licensenumber"),
        _null_when(k % 13 == 0, F.concat(F.lit("SN"), (F.col("o_custkey") % 20).cast("string"))).alias("serialnumber"),
        F.col("o_orderpriority").alias("user3"),
        F.lit(None).cast("string").alias("user4"),
        F.when(k % 3 == 0, F.lit("VIDEO")).otherwise(F.lit("REEL")).alias("gametype"),
        _null_when(k % 11 == 0, k % 9 != 0).alias("inuse"),
        F.col("o_orderdate").alias("lastchanged"),
        F.concat(F.lit("user"), (k % 7).cast("string")).alias("lastchangedby"),
        k.alias("_k"),
    )
    ranked = chunked_row_number(base, ["macaddr"], [F.col("_k")], "rev",
                                chunk=F.floor(F.col("_k") / F.lit(65536)))
    return ranked.withColumn("rev", F.col("rev").cast("long")).drop("_k")


def meter_day(spark: SparkSession, sf: str) -> DataFrame:
    """Meter days; positions divisible by five stop after 10 Jan; sentinel dates injected."""
    e = _events(spark, sf, "event_id", "ts")
    eid, day = F.col("event_id"), F.to_date("ts")
    e = e.filter((eid % 5 != 0) | (day <= F.lit(dt.date(2024, 1, 10))))
    swap = F.when((eid % 45 % 3 == 0) & (day > F.lit(dt.date(2024, 1, 12))), 1).otherwise(0)
    return e.select(
        (F.lit(BASE_IP) + eid % 45).cast("int").alias("ipaddr"),
        (1000 + (eid % 45) * 2 + swap).alias("macaddr"),
        F.when(eid % 401 == 0, F.lit(dt.date(1900, 1, 1))).when(eid % 409 == 0, F.lit(dt.date(2155, 1, 1)))
        .otherwise(day).alias("gamingday"),
        F.col("ts").alias("generated"),
    )


def player_session_v7(spark: SparkSession, sf: str) -> DataFrame:
    """Session log covering positions 31..50 of the base, so both outer-join sides have misses."""
    e = _events(spark, sf, "event_id", "ts", "event_type").filter(F.col("event_type") == "view")
    return e.select((F.lit(BASE_IP + 30) + F.col("event_id") % 20).cast("int").alias("ipaddr"),
                    F.to_date("ts").alias("gamingday"))


class Bronze:
    """Lazy accessor for all bronze shapes of one table directory.

    Each shape is built once per accessor and then reused: DataFrames are
    immutable plans, so sharing them is safe, saves the Python-side plan
    construction, and lets Spark reuse identical sub-plans (exchange reuse)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        fn = globals().get(name)
        if fn is None or name.startswith("_") or not callable(fn) or name == "Bronze":
            raise AttributeError(name)
        df = fn(self.spark, self.sf)
        self.__dict__[name] = df
        return df

    @cached_property
    def agents_players(self) -> DataFrame:
        """Agent history after the keyed upsert (last copy per key wins)."""
        from ..operators.dedupe import latest_per_key
        return latest_per_key(agents_players_src(self.spark, self.sf), ["membership", "datechange"],
                              [F.col("seq")]).drop("seq")

    @cached_property
    def fx_rates(self) -> DataFrame:
        from ..operators.dedupe import latest_per_key
        return latest_per_key(fx_rates_src(self.spark, self.sf), ["idcasino", "datechange", "idcurrency"],
                              [F.col("row_version")])


_ACCESSORS: dict[tuple[int, str], tuple[tuple, Bronze]] = {}


def bronze_for(spark: SparkSession, sf_dir: str) -> Bronze:
    """The shared accessor of one session and table directory.

    Its DataFrames keep the file listing of their first use; when the input
    folder has changed since, a new accessor is made."""
    from .tables import folder_state
    key = (id(spark), sf_dir)
    state = folder_state(spark, sf_dir)
    known, b = _ACCESSORS.get(key, (None, None))
    if b is None or known != state or b.spark is not spark:
        b = Bronze(spark, sf_dir)
        _ACCESSORS[key] = (state, b)
    return b


def reset_accessors(spark: SparkSession | None = None) -> None:
    """Forget shared accessors and remembered scans (of one session, or all)."""
    from .tables import forget_scans
    for key in [k for k in _ACCESSORS if spark is None or k[0] == id(spark)]:
        del _ACCESSORS[key]
    forget_scans(spark)
