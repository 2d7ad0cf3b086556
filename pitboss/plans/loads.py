"""Load procedures: compute a fact for a day range and apply it to its table.

Each mirrors one stored procedure of the warehouse: delete the range (or the
agent's rows in the range), insert the recomputed rows.  On parquet that is a
partition rewrite (``pitboss.sources.sinks``); days of the range that come out
empty lose their partition.  ``tables`` maps a table name to its path.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import registry, sinks, swap
from . import gold, positions, quality, silver

DAY = "gamingday"


def _session(b) -> SparkSession:
    """Session of the bronze accessor, or the active one for a plain namespace of DataFrames."""
    return getattr(b, "spark", None) or SparkSession.active()


def load_membership_day(b, f: dt.date, t: dt.date, path: str, agent_id: int | None = None) -> None:
    """Member-day fact: range refresh, or agent-scoped refresh when ``agent_id`` is given.
    The gold copy of the reference is the same table here."""
    new = silver.membership_day(b, f, t, agent_id=agent_id)
    if agent_id is None:
        sinks.write_range_refresh(new, path, DAY, f, t, cluster_by=["membership"])
    else:
        sinks.write_scoped_refresh(new, path, DAY, f, t, "idagent", agent_id, [DAY, "membership"])


def load_player_session(b, f: dt.date, t: dt.date, path: str) -> None:
    sinks.write_range_refresh(silver.player_session(b, f, t), path, DAY, f, t, cluster_by=["membership"])


def load_fx_rate_daily(b, f: dt.date, t: dt.date, path: str) -> None:
    sinks.write_range_refresh(silver.fx_rate_daily(b, f, t), path, "datechange", f, t)


def load_session_marts(b, f: dt.date, t: dt.date, tables: Mapping[str, str]) -> None:
    """Player-session fact, then both marts computed from the stored fact."""
    load_player_session(b, f, t, tables["fact_player_session"])
    spark = _session(b)
    stored = swap.read_table(spark, tables["fact_player_session"])
    sinks.write_range_refresh(gold.mart_table_game(b, f, t, sessions=stored), tables["fact_session_day_by_table_game"],
                              DAY, f, t)
    sinks.write_range_refresh(gold.mart_agent_group(b, f, t, sessions=stored),
                              tables["fact_session_day_by_agent_group"], DAY, f, t)


def load_player_expenses(b, f: dt.date, t: dt.date, path: str) -> None:
    sinks.write_range_refresh(gold.player_expenses(b, f, t), path, DAY, f, t, cluster_by=["membership"])


def load_player_bonuses(b, f: dt.date, t: dt.date, path: str) -> None:
    sinks.write_range_refresh(gold.player_bonuses(b, f, t), path, DAY, f, t, cluster_by=["membership"])


def load_dim_position(b, as_of: dt.date, tables: Mapping[str, str]) -> None:
    """Position dimension and machine-history bridge: full refresh (truncate + insert)."""
    activity = positions.egd_activity(b.meter_day, b.player_session_v7)
    sinks.write_full_refresh(positions.dim_position(activity, b.egd_cfg, as_of), tables["dim_egd_position"])
    sinks.write_full_refresh(positions.machine_history(b.egd_cfg), tables["bridge_egd_machine_history"])


def load_reference_dims(b, tables: Mapping[str, str]) -> None:
    """Keyed upsert of the reference dimensions that ``tables`` names: rows of the
    source replace the stored rows of their key, stored rows without a source
    row stay."""
    for name, (_, key, _) in silver.REFERENCE_DIMS.items():
        if name in tables:
            sinks.write_upsert(silver.reference_dim(b, name), tables[name], list(key), F.lit(0))


def load_reference_and_facts(b, f: dt.date, t: dt.date, tables: Mapping[str, str]) -> None:
    """Reference dimensions, FX rates and player sessions of a range in one call."""
    load_reference_dims(b, tables)
    load_fx_rate_daily(b, f, t, tables["fact_fx_rate_daily"])
    load_player_session(b, f, t, tables["fact_player_session"])


def _window(spark: SparkSession, md_path: str, yesterday: dt.date, lookback_days: int | None) -> tuple[dt.date, dt.date]:
    """Days to load (K1), read off the stored member-day fact."""
    if lookback_days is not None:
        return yesterday - dt.timedelta(days=lookback_days), yesterday
    if not swap.table_exists(spark, md_path):
        return yesterday, yesterday
    w = quality.refresh_window(swap.read_table(spark, md_path), DAY, yesterday).collect()[0]
    return w["from_day"], w["to_day"]


def gated_refresh(b, tables: Mapping[str, str], yesterday: dt.date, failed: Iterable[str] = (),
                  lookback_days: int | None = None):
    """The daily loads behind a gate: a table one of whose sources (``failed``, by
    source name) has not been loaded is left as it is, and so is one whose own
    load fails; the others go on.  Returns one row per table: (table_name,
    status loaded / held back / failed, reason).

    The member-day fact moves the window of the next run, so it is held back
    too if any other fact of the window has not been loaded: the next run then
    loads the same days again."""
    spark = _session(b)
    f, t = _window(spark, tables["fact_membership_day"], yesterday, lookback_days)

    def sessions() -> None:
        if {"fact_session_day_by_table_game", "fact_session_day_by_agent_group"} <= set(tables):
            load_session_marts(b, f, t, tables)
        else:
            load_player_session(b, f, t, tables["fact_player_session"])
    steps: dict[str, Callable[[], None]] = {
        name: (lambda name=name: load_reference_dims(b, {name: tables[name]})) for name in silver.REFERENCE_DIMS}
    steps |= {
        "fact_fx_rate_daily": lambda: load_fx_rate_daily(b, f, t, tables["fact_fx_rate_daily"]),
        "fact_player_session": sessions,
        "fact_player_expenses": lambda: load_player_expenses(b, f, t, tables["fact_player_expenses"]),
        "fact_player_bonuses": lambda: load_player_bonuses(b, f, t, tables["fact_player_bonuses"]),
        "fact_membership_day": lambda: load_membership_day(b, f, t, tables["fact_membership_day"]),
    }
    rows: list[tuple[str, str, str | None]] = []
    for name, step in steps.items():
        if name not in tables:
            continue
        lacking = registry.missing_sources(name, failed)
        behind = [n for n, status, _ in rows if n.startswith("fact_") and status != "loaded"]
        if lacking:
            rows.append((name, "held back", "not loaded: " + ", ".join(lacking)))
        elif name == "fact_membership_day" and behind:
            rows.append((name, "held back", "days open in: " + ", ".join(behind)))
        else:
            try:
                step()
                rows.append((name, "loaded", None))
            except Exception as e:  # the row says so; the other tables go on
                rows.append((name, "failed", f"{type(e).__name__}: {e}"[:2000]))
    return spark.createDataFrame(rows, "table_name string, status string, reason string")


def daily_run(spark: SparkSession, source, root: str, tables: Mapping[str, str], yesterday: dt.date,
              run_at: dt.datetime, lookback_days: int | None = None):
    """One whole day: bronze sources into ``root``, then the gated loads from the
    stored bronze.  Returns the rows of ``gated_refresh``."""
    errors = registry.load_bronze(spark, source, root, run_at, run_at.date())
    b = registry.StoredBronze(spark, root)
    return gated_refresh(b, tables, yesterday, [name for name, e in errors.items() if e], lookback_days)


def daily_refresh(b, tables: Mapping[str, str], yesterday: dt.date, agent_id: int | None = None,
                  lookback_days: int | None = None, as_of: dt.date | None = None):
    """One daily run (the flow without its scheduler): resolve the window from
    the stored member-day fact (K1: catch up from the last loaded day, else
    yesterday only; with ``lookback_days`` the fixed window before yesterday),
    load the dimensions, facts and marts for it, and return the health check
    of ``yesterday`` (K2) as a one-row DataFrame.  Only the window's two dates
    reach the driver.

    The member-day fact is written last: the window is read off it, so a run
    that fails earlier leaves the window open and the next run fills every
    table again.  Optional tables (dimensions, FX, positions) are loaded when
    ``tables`` names them."""
    spark = _session(b)
    md_path = tables["fact_membership_day"]
    f, t = _window(spark, md_path, yesterday, lookback_days)
    load_reference_dims(b, tables)
    if "fact_fx_rate_daily" in tables:
        load_fx_rate_daily(b, f, t, tables["fact_fx_rate_daily"])
    load_session_marts(b, f, t, tables)
    load_player_expenses(b, f, t, tables["fact_player_expenses"])
    load_player_bonuses(b, f, t, tables["fact_player_bonuses"])
    if {"dim_egd_position", "bridge_egd_machine_history"} <= set(tables):
        load_dim_position(b, as_of or yesterday, tables)
    load_membership_day(b, f, t, md_path, agent_id)
    return quality.health_check(swap.read_table(spark, md_path), DAY, yesterday)
