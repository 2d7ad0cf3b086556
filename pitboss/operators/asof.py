"""As-of look-up: for each probe row, the latest history row at or before it.

SQL engines usually write this as a correlated ``ORDER BY t DESC LIMIT 1``
sub-query.  Catalyst plans that as a nested-loop join on the time predicate,
so here it is a sort-based merge instead: probes and history rows are stacked
(``unionByName``), ordered by ``(key, t, side)`` with history rows first at
equal ``t`` (so ``<=`` is inclusive), and each probe takes the last non-null
history payload before it.  Cost: one shuffle by key and a sort, O(n log n).

The payload is wrapped in a struct, so a history row whose value is NULL is
still "the latest row" (its NULL is returned rather than an older value).

With ``split_by_day`` the scan is two-level (``pitboss.operators.scan``):
chunks are days (or hours), so a key with a third of all rows is spread over
its days; ``counted``, the probes' keys and times, also splits busy ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import balanced_chunks, carry_last

EARLY_DAY = "0001-01-01"


def asof_last(probe: DataFrame, history: DataFrame, by: Sequence[str], probe_time: str, hist_time: str,
              payload: Sequence[str], out: str = "asof", hist_tiebreak: Sequence[Column] = (),
              split_by_day: bool = False, history_keys: DataFrame | None = None,
              chunk_unit: str = "day", counted: DataFrame | None = None) -> DataFrame:
    """Probe rows plus ``out``: struct of ``payload`` from the latest history row
    with ``hist_time <= probe_time`` (NULL when there is none).

    ``hist_tiebreak``: ascending columns ordering history rows with equal time;
    the greatest wins.  History rows with NULL time never match, and a probe
    with NULL time matches nothing.
    """
    tb = list(hist_tiebreak)
    # Only history of keys that are probed can match: semi-join first, so a
    # one-day run does not sort the whole history (the probe key set of a
    # short run is small and can be broadcast after the planner measures it).
    # ``history_keys`` may name a cheaper superset of the probe keys when the
    # probe itself is the result of a large plan.
    keys = (history_keys if history_keys is not None else probe).select(*by)
    history = history.join(keys, list(by), "left_semi")
    h = history.filter(F.col(hist_time).isNotNull()).select(
        *[F.col(k) for k in by],
        F.col(hist_time).cast("timestamp_ntz").alias("_t"),
        F.lit(0).alias("_side"),
        *[c.alias(f"_tb{i}") for i, c in enumerate(tb)],
        F.struct(*[F.col(p) for p in payload]).alias("_payload"),
    )
    p = probe.withColumn("_t", F.col(probe_time).cast("timestamp_ntz")).withColumn("_side", F.lit(1))
    u = p.unionByName(h, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_side"), *[F.col(f"_tb{i}") for i in range(len(tb))]]
    early = F.lit(EARLY_DAY).cast("timestamp_ntz")
    chunk = F.coalesce(F.date_trunc(chunk_unit, F.col("_t")), early) if split_by_day else None
    if split_by_day and counted is not None:
        tries = counted.select(*by, F.col(probe_time).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"),
                               *[F.lit(None).cast(u.schema[f"_tb{i}"].dataType).alias(f"_tb{i}") for i in range(len(tb))])
        u, chunk = balanced_chunks(u, by, order, chunk, counted=tries)
    res = carry_last(u, list(by), order, "_payload", out, chunk=chunk, keep=F.col("_side") == 1)
    res = res.withColumn(out, F.when(F.col("_t").isNotNull(), F.col(out)))
    return res.drop("_t", "_side", "_sub", "_payload", *[f"_tb{i}" for i in range(len(tb))])


def agent_at(probe: DataFrame, agent_history: DataFrame, players: DataFrame, member: str, probe_time: str,
             split_by_day: bool = False, player_cols: Sequence[str] = (),
             member_keys: DataFrame | None = None, chunk_unit: str = "day",
             counted: DataFrame | None = None) -> DataFrame:
    """Agent of a member at a time (C5): latest history row (ties: later
    ``created`` first, NULL ``created`` first of all), else the player's own
    agent with 0 read as none.  A history agent 0 stays 0.  ``player_cols``
    are carried over from the same player join."""
    hist = agent_history.select(F.col("membership").alias(member), "datechange", "created", "idagent")
    tiebreak = [F.col("created").isNull(), F.col("created")]
    hit = asof_last(probe, hist, [member], probe_time, "datechange", ["idagent"], "_agent", tiebreak,
                    split_by_day=split_by_day, history_keys=member_keys, chunk_unit=chunk_unit, counted=counted)
    pl = players.select(F.col("membership").alias("_pm"), F.col("idagent").alias("_pagent"), *player_cols)
    joined = hit.join(pl, hit[member] == pl["_pm"], "left")
    return joined.withColumn("idagent", F.coalesce(F.col("_agent.idagent"), F.nullif(F.col("_pagent"), F.lit(0)))) \
        .drop("_agent", "_pm", "_pagent")
