"""The bronze sources of the warehouse, and which loads need which of them.

Each source is declared once: how it is watermarked, what it re-reads, which
rows it leaves at the source.  Its columns and its upsert key are those of its
bronze table (``schemas``).  ``load_bronze`` runs all of them one by one; a
source that fails is logged and the others go on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ingest, schemas, swap
from .sinks import conform


@dataclass(frozen=True)
class Source:
    """One source table.  Without a watermark every run reads a full snapshot."""
    name: str
    shape: str
    watermark: str | None = None
    kind: str = "int"
    reread: str | None = None       # the last days of this column are read again
    member: str | None = None       # rows without a member stay at the source


# The 24 sources in loading order, with their watermarks.
SOURCES = (
    Source("Person.Visits", "visits", "created", "datetime", member="membership"),
    Source("Manage.Agents_Players", "agents_players", "datechange", "datetime", member="membership"),
    Source("Manage.Agent_Groups", "agent_groups", "modified", "datetime", reread="datebegin"),
    Source("Person.Players", "players", "membership"),
    Source("Manage.Agents", "agents", "idagent"),
    Source("Casino.Countries", "countries", "idcountry"),
    Source("CashDesk.Articles", "articles"),
    Source("Casino.Games", "games"),
    Source("Casino.TableTypesGames", "table_type_games"),
    Source("Casino.TableTypes", "table_types"),
    Source("Casino.Tables", "tables_ref"),
    Source("Casino.Currency_ExchRates", "fx_rates", "row_version"),
    Source("CashDesk.view_Transactions", "cashdesk_tx", "idoper", reread="datework", member="membership"),
    Source("Casino.Transactions_Calculated", "tx_calculated", "idoper"),
    Source("Manage.PlayerSessions", "player_sessions", "idplayerstracking", reread="timestart"),
    Source("DRGT.Sessions", "drgt_sessions", "id_session", reread="gamingday", member="playerid"),
    Source("Casino.Transaction_Money", "tx_money", "idoper"),
    Source("Casino.Chips", "chips"),
    Source("Manage.PlayerSession_Details", "session_details", "idplayersessiondetail"),
    Source("Manage.PlayerSession_Detail_Chips", "session_detail_chips", "idplayersessiondetail"),
    Source("Promo.PlayerBonuses", "bonuses", "idplayerbonus", reread="datework"),
    Source("Promo.BonusIndicators", "bonus_indicators"),
    Source("Promo.BonusIndicators_Games", "indicator_games"),
    Source("Manage.view_PlayersTracking", "players_tracking", "idplayerstracking", reread="datework", member="membership"),
)

# The shapes each load reads.
_MEMBERS = ("agents_players", "players", "agents", "countries")
NEEDS: dict[str, tuple[str, ...]] = {
    "dim_game": ("games",),
    "dim_table_type": ("table_types",),
    "bridge_table_type_game": ("table_type_games",),
    "dim_table": ("tables_ref",),
    "dim_agent_group_scd": ("agent_groups", "agents"),
    "fact_fx_rate_daily": ("fx_rates",),
    "fact_player_session": ("player_sessions", "players_tracking", "players", "agent_groups"),
    "fact_player_expenses": ("cashdesk_tx", "tx_money", "articles", *_MEMBERS),
    "fact_player_bonuses": ("bonuses", "games", *_MEMBERS),
    "fact_membership_day": ("visits", "drgt_sessions", "cashdesk_tx", "tx_calculated", "tx_money", "player_sessions",
                            "players_tracking", "session_details", "session_detail_chips", "chips", *_MEMBERS),
}


def config(source: Source, border: str = "strict") -> ingest.SourceConfig:
    """The source as the incremental loader takes it; it is checked against its bronze table."""
    table = schemas.ADAPTER_TABLE[source.shape]
    names = tuple(schemas.schema(table).names)
    for column in (source.watermark, source.reread, source.member):
        if column is not None and column not in names:
            raise ValueError(f"{source.name}: {table} has no column {column}")
    return ingest.SourceConfig(
        source.name, names, source.watermark or "__full_snapshot__", source.kind, schemas.key(table),
        lookback_column=source.reread, full_snapshot=source.watermark is None, member_column=source.member,
        border=border)


def missing_sources(load: str, failed: Iterable[str]) -> list[str]:
    """The failed sources that a load needs."""
    down = set(failed)
    return [s.name for s in SOURCES if s.name in down and s.shape in NEEDS.get(load, ())]


def bronze_path(root: str, shape: str) -> str:
    return f"{root.rstrip('/')}/{schemas.ADAPTER_TABLE[shape]}"


def load_bronze(spark: SparkSession, source, root: str, run_at: dt.datetime, today: dt.date,
                sources: Iterable[Source] = SOURCES, border: str = "strict") -> dict[str, str | None]:
    """Load the sources into the bronze tables below ``root``.

    ``source`` gives each source's current rows as an attribute named after its
    shape; a source that cannot even be opened counts as failed.  Returns each
    source's error, None for success."""
    out: dict[str, str | None] = {}
    for s in sources:
        try:
            schema = schemas.schema(schemas.ADAPTER_TABLE[s.shape])
            rows = conform(getattr(source, s.shape), schema)
        except Exception as e:
            ingest.log_run(spark, f"{root}/run_log", s.name, run_at, error=f"{type(e).__name__}: {e}")
            out[s.name] = f"{type(e).__name__}: {e}"
            continue
        out |= ingest.run_sources(spark, [{
            "source": rows, "cfg": config(s, border), "target_path": bronze_path(root, s.shape),
            "control_path": f"{root}/watermarks", "log_path": f"{root}/run_log",
            "seq": F.col(s.watermark) if s.watermark else F.lit(0), "run_at": run_at, "today": today}])
    return out


class StoredBronze:
    """Accessor of the bronze tables below ``root``; a table never loaded is empty."""

    def __init__(self, spark: SparkSession, root: str, others: Mapping[str, DataFrame] | None = None):
        self.spark, self._root, self._others = spark, root, dict(others or {})

    def __getattr__(self, name: str) -> DataFrame:
        if name in self._others:
            return self._others[name]
        if name not in schemas.ADAPTER_TABLE:
            raise AttributeError(name)
        schema = schemas.schema(schemas.ADAPTER_TABLE[name])
        rows = conform(swap.read_table(self.spark, bronze_path(self._root, name), schema), schema)
        self.__dict__[name] = rows
        return rows
