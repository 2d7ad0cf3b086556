"""The source registry, its load gate, and what arrives at the watermark's border."""

import datetime as dt
import os
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pitboss.plans import loads
from pitboss.sources import ingest, registry, schemas, swap

AT = [dt.datetime(2024, 1, d, 12) for d in range(1, 8)]
RUN = dt.datetime(2024, 1, 20, 6)


def _root():
    return tempfile.mkdtemp(prefix="pitboss-test-")


def test_all_sources_fit_their_tables():
    assert len(registry.SOURCES) == 24 and len({s.name for s in registry.SOURCES}) == 24
    for s in registry.SOURCES:
        cfg = registry.config(s)
        assert cfg.full_snapshot == (s.watermark is None)
        assert cfg.key or s.shape == "visits"
    assert sum(s.reread is not None for s in registry.SOURCES) == 6
    with pytest.raises(ValueError, match="no column"):
        registry.config(registry.Source("X", "visits", "modified"))
    for load, shapes in registry.NEEDS.items():
        assert set(shapes) <= {s.shape for s in registry.SOURCES}, load


VISITS = "datework date, membership long, time_in timestamp_ntz, time_out timestamp_ntz, created timestamp_ntz"


def _visit(member, at, out=None):
    return (at.date(), member, at, out, at)


def _load(spark, root, rows, run_at=RUN, **changes):
    cfg = ingest.SourceConfig("Person.Visits", tuple(VISITS.replace(",", "").split()[::2]), "created", "datetime", **changes)
    ingest.run_incremental(spark, spark.createDataFrame(rows, VISITS), cfg, f"{root}/visits", f"{root}/wm", f"{root}/log",
                           F.col("created"), run_at, run_at.date())
    return sorted((r["membership"], r["created"], r["time_out"]) for r in spark.read.parquet(f"{root}/visits").collect())


@pytest.mark.parametrize("border", ["strict", "inclusive"])
def test_rows_that_share_the_last_instant(spark, border):
    """A second visit at the watermark's instant, and an exact copy of the first one, arrive later."""
    root = _root()
    rows = [_visit(1, AT[0]), _visit(2, AT[1])]
    _load(spark, root, rows, border=border)
    rows += [_visit(3, AT[1]), _visit(2, AT[1])]
    late = [(1, AT[0], None), (2, AT[1], None)] + ([(2, AT[1], None), (3, AT[1], None)] if border == "inclusive" else [])
    for _ in range(3):
        assert _load(spark, root, rows, border=border) == late
    rows += [_visit(4, AT[1]), _visit(5, AT[2])]
    last = late + ([(4, AT[1], None)] if border == "inclusive" else []) + [(5, AT[2], None)]
    for _ in range(2):
        assert _load(spark, root, rows, border=border) == last
    assert ingest.read_watermark(spark, f"{root}/wm", "Person.Visits") == "2024-01-03T12:00:00.000000"


def test_inclusive_border_repeated_after_a_failure(spark, monkeypatch):
    root = _root()
    _load(spark, root, [_visit(1, AT[0])], border="inclusive")
    rows = [_visit(1, AT[0]), _visit(2, AT[0]), _visit(3, AT[1])]
    with monkeypatch.context() as m:
        m.setattr(ingest, "advance_watermark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _load(spark, root, rows, border="inclusive")
    for _ in range(2):
        assert [m for m, *_ in _load(spark, root, rows, border="inclusive")] == [1, 2, 3]


def test_late_checkouts_by_key_and_reread(spark):
    """The option that repairs visits: a key, and the last days read again."""
    root = _root()
    option = {"key": ("datework", "membership", "time_in"), "lookback_column": "datework", "lookback_days": 3}
    old, new = _visit(1, dt.datetime(2024, 1, 10, 20)), _visit(2, dt.datetime(2024, 1, 18, 20))
    _load(spark, root, [old, new], **option)
    out = dt.datetime(2024, 1, 19, 2)
    got = _load(spark, root, [old[:3] + (out, old[4]), new[:3] + (out, new[4])], **option)
    assert [(m, t) for m, _, t in got] == [(1, None), (2, out)]  # the old one is outside the window


def test_null_and_minus_one_are_one_key(spark):
    source = next(s for s in registry.SOURCES if s.shape == "indicator_games")
    schema = schemas.schema("promo_bonus_indicators_games")
    root = _root()

    def load(*rows):
        df = spark.createDataFrame([(g, m, AT[0], None, hands, None) for g, m, hands in rows], schema)
        registry.load_bronze(spark, SimpleNamespace(indicator_games=df), root, RUN, RUN.date(), [source])
    load((-1, 5, 10), (2, 5, 11))
    load((None, 5, 20), (2, -1, 21))
    load((2, None, 31))
    rows = registry.StoredBronze(spark, root).indicator_games.collect()
    assert sorted((r["idgame"] or -1, r["idslotmanufacturer"] or -1, r["handsperhour"]) for r in rows) == [
        (-1, 5, 20), (2, -1, 31), (2, 5, 11)]


class Broken:
    """The fixture sources, of which some cannot be opened."""

    def __init__(self, bronze, *down):
        self.bronze, self.down = bronze, down

    def __getattr__(self, name):
        if name in self.down:
            raise OSError(f"{name} is not reachable")
        return getattr(self.bronze, name)


def test_a_failed_source_holds_back_the_facts_that_need_it(spark):
    from pitboss.sources.adapters import Bronze
    bronze, root = Bronze(spark, "/root/testdata/sf0.001"), _root()
    names = ("dim_game", "fact_fx_rate_daily", "fact_player_expenses", "fact_player_bonuses", "fact_membership_day")
    tables = {n: os.path.join(root, n) for n in names}
    day = dt.date(2024, 1, 17)
    needed = {shape for n in names for shape in registry.NEEDS[n]}
    sources = [s for s in registry.SOURCES if s.shape in needed]

    def run(source, yesterday):
        errors = registry.load_bronze(spark, source, f"{root}/bronze", RUN, RUN.date(), sources)
        out = loads.gated_refresh(registry.StoredBronze(spark, f"{root}/bronze"), tables, yesterday,
                                  [n for n, e in errors.items() if e])
        return {r["table_name"]: (r["status"], r["reason"]) for r in out.collect()}

    def days(name):
        return {r[0] for r in swap.read_table(spark, tables[name]).select("gamingday").distinct().collect()}
    first = run(bronze, day)
    assert {s for s, _ in first.values()} == {"loaded"}
    before = days("fact_membership_day")
    assert before == {day}
    held = run(Broken(bronze, "articles"), dt.date(2024, 1, 18))
    assert held["fact_player_expenses"] == ("held back", "not loaded: CashDesk.Articles")
    assert held["fact_membership_day"] == ("held back", "days open in: fact_player_expenses")
    assert held["fact_player_bonuses"][0] == "loaded" and held["dim_game"][0] == "loaded"
    assert days("fact_membership_day") == before and days("fact_player_expenses") <= {day}
    log = spark.read.parquet(f"{root}/bronze/run_log").filter("status = 'failed'").collect()
    assert [r["source_table"] for r in log] == ["CashDesk.Articles"] and "not reachable" in log[0]["error_message"]
    # all sources are back: the open day is caught up
    assert {s for s, _ in run(bronze, dt.date(2024, 1, 19)).values()} == {"loaded"}
    assert days("fact_membership_day") == {dt.date(2024, 1, d) for d in (17, 18, 19)}
