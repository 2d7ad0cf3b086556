"""Detail tables that carry their parent's day: placement, late and moved parents, plans."""

import datetime as dt
import os
import re
import tempfile
from decimal import Decimal
from types import SimpleNamespace

import pytest

from pitboss.plans import silver
from pitboss.sources import daypart, schemas
from pitboss.sources.daypart import CARRIED

D = [dt.date(2024, 1, d) for d in range(1, 8)]
AT = dt.datetime(2024, 1, 5, 12)


def _df(spark, shape, rows):
    schema = schemas.schema(schemas.ADAPTER_TABLE[shape])
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def _tables():
    root = tempfile.mkdtemp(prefix="pitboss-test-")
    return {link.table: os.path.join(root, link.table) for link in daypart.LINKS}


def _days(spark, path, key):
    return {r[key]: r[CARRIED] for r in spark.read.parquet(path).collect()}


@pytest.fixture
def chain(spark):
    """Two sessions with one detail of two chips each; tracking 3 has no day, session 4 no tracking."""
    track = _df(spark, "players_tracking", [
        {"idplayerstracking": 1, "datework": D[0], "membership": 9}, {"idplayerstracking": 2, "datework": D[1], "membership": 9},
        {"idplayerstracking": 3, "datework": None, "membership": 9}])
    sessions = _df(spark, "player_sessions", [
        {"idplayerstracking": k, "idplayersession": 10 + k, "timestart": AT if k != 4 else None} for k in (1, 2, 3, 4)])
    details = _df(spark, "session_details", [
        {"idplayersessiondetail": 100 + k, "idplayersession": 10 + k} for k in (1, 2, 3, 4, 5)])
    chips = _df(spark, "session_detail_chips", [
        {"idplayersessiondetail": 100 + k, "idchip": c, "qntchips": Decimal(1)} for k in (1, 2, 3, 4, 5) for c in (1, 2)])
    return {"players_tracking": track, "player_sessions": sessions, "session_details": details,
            "session_detail_chips": chips}


WANT = {1: D[0], 2: D[1], 3: D[4], 4: None, 5: None}


def _check(spark, tables, want):
    assert _days(spark, tables["session_details"], "idplayersession") == {10 + k: d for k, d in want.items()}
    assert _days(spark, tables["session_detail_chips"], "idplayersessiondetail") == {100 + k: d for k, d in want.items()}
    assert spark.read.parquet(tables["session_detail_chips"]).count() == 10


def test_days_go_down_the_chain(spark, chain):
    tables = _tables()
    for _ in range(2):
        daypart.load_with_days(spark, chain, {"players_tracking": chain["players_tracking"]}, tables)
        _check(spark, tables, WANT)


def test_children_before_their_parents(spark, chain):
    tables, none = _tables(), chain["players_tracking"].limit(0)
    daypart.load_with_days(spark, {k: v for k, v in chain.items() if k != "players_tracking"}, {"players_tracking": none}, tables)
    _check(spark, tables, {k: D[4] if k < 4 else None for k in WANT})  # the session's own start, for want of a tracking row
    daypart.load_with_days(spark, {"players_tracking": chain["players_tracking"]},
                           {"players_tracking": chain["players_tracking"]}, tables)
    _check(spark, tables, WANT)


def test_a_moved_parent_takes_its_children_along(spark, chain):
    tables = _tables()
    daypart.load_with_days(spark, chain, {"players_tracking": chain["players_tracking"]}, tables)
    moved = _df(spark, "players_tracking", [{"idplayerstracking": 2, "datework": D[6], "membership": 9}])
    after = chain["players_tracking"].where("idplayerstracking <> 2").unionByName(moved)
    new_chip = _df(spark, "session_detail_chips", [{"idplayersessiondetail": 102, "idchip": 1, "qntchips": Decimal(7)}])
    for _ in range(2):
        daypart.load_with_days(spark, {"players_tracking": moved, "session_detail_chips": new_chip},
                               {"players_tracking": after}, tables)
        _check(spark, tables, WANT | {2: D[6]})
        chips = {(r["idplayersessiondetail"], r["idchip"]): r["qntchips"]
                 for r in spark.read.parquet(tables["session_detail_chips"]).collect()}
        assert chips[102, 1] == 7 and chips[102, 2] == 1
    folders = [n for n in os.listdir(tables["session_details"]) if "=" in n]
    assert f"{CARRIED}=2024-01-02" not in folders


def test_a_parent_with_two_days_raises(spark, chain):
    twice = chain["players_tracking"].unionByName(
        _df(spark, "players_tracking", [{"idplayerstracking": 1, "datework": D[3], "membership": 9}]))
    with pytest.raises(Exception, match="two days"):
        daypart.load_with_days(spark, {"player_sessions": chain["player_sessions"]}, {"players_tracking": twice}, _tables())


def test_one_day_reads_one_day(spark):
    """Partition filters on all three detail scans, and only that day's files."""
    from pitboss.catalog.entries_stored import day_tables
    b = day_tables(spark, "/root/testdata/sf0.01")
    day = dt.date(2024, 1, 10)
    df = silver.tracking_day(b, day, day)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in re.findall(r"FileScan parquet[^\n]*", plan) if CARRIED in x]
    assert len(scans) == 3 and all(re.search(r"PartitionFilters: \[[^]]*carried_day", x) for x in scans)
    assert all("PartitionFilters: []" not in x for x in scans)
    for table in ("player_sessions", "session_details", "session_detail_chips"):
        rows = getattr(b, table)
        read = {r[0] for r in daypart.of_days(rows, day, day).selectExpr("input_file_name()").distinct().collect()}
        assert read and all(f"{CARRIED}=2024-01-10" in f for f in read)


def test_member_day_reads_each_source_once(spark):
    from pitboss.catalog.entries_stored import day_tables
    b = day_tables(spark, "/root/testdata/sf0.01")
    f, t = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    cash, track = b.cashdesk_tx, b.players_tracking
    marked = SimpleNamespace(**{n: getattr(b, n) for n in (
        "visits", "agents_players", "players", "agents", "countries", "tx_calculated", "tx_money", "player_sessions",
        "drgt_sessions", "session_details", "session_detail_chips", "chips")})
    tables = {"cashdesk_tx": cash, "players_tracking": track}
    root = tempfile.mkdtemp(prefix="pitboss-test-")
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
        setattr(marked, name, spark.read.parquet(f"{root}/{name}"))
    plan = silver.membership_day(marked, f, t)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet[^\n]*", plan)
    # the columns that only one source has
    for columns in (r"idoper#\d+L?,datework#", r"idplayerstracking#\d+L?,datework#", r"timestart#",
                    r"idplayersessiondetail#\d+L?,idplayersession#", r"qntchips#", r"summoney#", r"deposit#"):
        assert sum(bool(re.search(r"FileScan parquet \[[^]]*" + columns, x)) for x in scans) == 1, (columns, scans)


def test_member_day_is_the_same_from_stored_details(spark, bronze):
    from pitboss.catalog.entries_stored import day_tables
    f, t = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    b = day_tables(spark, "/root/testdata/sf0.01")
    for fn in (silver.membership_day, silver.player_session):
        a, c = fn(b, f, t), fn(bronze, f, t)
        assert a.count() == c.count() and a.exceptAll(c).count() == 0
