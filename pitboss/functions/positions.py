"""Position codes and age-based status labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status thresholds in days.
ACTIVE_DAYS = 7
RECENT_DAYS = 90


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(c: Column | str, n: int) -> Column:
    """Integer division of a non-negative integer column (SQL ``div``)."""
    return F.floor(_c(c) / F.lit(n)).cast("long")


def ip_readable(ip: Column | str) -> Column:
    """Packed IPv4 integer -> dotted text."""
    return F.concat_ws(".", _div(ip, 16777216).cast("string"), (_div(ip, 65536) % 256).cast("string"),
                       (_div(ip, 256) % 256).cast("string"), (_c(ip) % 256).cast("string"))


def floor_zone(ip: Column | str) -> Column:
    return (_div(ip, 256) % 256).cast("int")


def position_in_zone(ip: Column | str) -> Column:
    return (_c(ip) % 256).cast("int")


def status_by_age(last_seen: Column, as_of: dt.date, old_label: str, never_label: str) -> Column:
    """Active (seen within 7 days of ``as_of``), Recently Inactive (90 days),
    ``old_label`` (seen earlier), ``never_label`` (never seen)."""
    ref = F.lit(as_of.isoformat()).cast("date")
    return (F.when(last_seen >= F.date_sub(ref, ACTIVE_DAYS), "Active")
            .when(last_seen >= F.date_sub(ref, RECENT_DAYS), "Recently Inactive")
            .when(last_seen.isNotNull(), old_label)
            .otherwise(never_label))
