"""Row predicates and small scalar helpers (all JVM-side column expressions)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
ANONYMOUS_MEMBER = 5          # anonymous-entry member id, excluded everywhere
UNKNOWN_KEY = -1              # unknown-member key of the marts
OPEN_END = dt.date(2999, 12, 31)   # open end of an agent-group range
BRIDGE_OPEN_END = dt.date(9999, 12, 31)  # open end of a machine-history range


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_between(day: Column | str, from_day, to_day) -> Column:
    """Inclusive day range (B1); on a partition column this prunes partitions."""
    return _c(day).between(F.lit(from_day), F.lit(to_day))


def month_bounds(year: Column | int, month: Column | int) -> tuple[Column, Column]:
    """First and last day of a month."""
    first = F.make_date(*[x if isinstance(x, Column) else F.lit(x) for x in (year, month)], F.lit(1))
    return first, F.last_day(first)


def known_member(member: Column | str) -> Column:
    """Sentinel exclusion (B2): member not null and not the anonymous id."""
    m = _c(member)
    return m.isNotNull() & (m != ANONYMOUS_MEMBER)


def not_deleted(flag: Column | str) -> Column:
    """Soft-delete filter (B3): ``coalesce(flag, false) = false``."""
    return ~F.coalesce(_c(flag), F.lit(False))


def is_true(flag: Column | str) -> Column:
    """Three-valued flag read as true only when true."""
    return F.coalesce(_c(flag), F.lit(False))


def optional_equals(col: Column | str, value) -> Column:
    """``p IS NULL OR col = p`` (B6): no predicate at all when ``value`` is None."""
    return F.lit(True) if value is None else (_c(col) == F.lit(value))


def clean_text(c: Column | str) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def unknown_key(c: Column | str) -> Column:
    """``coalesce(id, -1)``."""
    return F.coalesce(_c(c), F.lit(UNKNOWN_KEY))


def gaming_day(day: Column | str, start: Column | str) -> Column:
    """``coalesce(datework, timestart::date)``."""
    return F.coalesce(_c(day), F.to_date(_c(start)))


def money(c: Column | str) -> Column:
    return _c(c).cast("decimal(19,4)")


def sign_split(direction: Column | str, amount: Column | str, sign: int) -> Column:
    """In/out split by direction (B7): ``abs(coalesce(x, 0))`` on the matching side, else 0."""
    if isinstance(direction, str) and isinstance(amount, str):
        # one SQL expression: the same plan, built with a single JVM call
        return F.expr(f"CAST(CASE WHEN {direction} = {int(sign)} THEN abs(coalesce(CAST({amount} AS DECIMAL(19,4)), "
                      f"CAST(0 AS DECIMAL(19,4)))) ELSE CAST(0 AS DECIMAL(19,4)) END AS DECIMAL(19,4))")
    return F.when(_c(direction) == sign, F.abs(F.coalesce(money(amount), F.lit(0).cast("decimal(19,4)")))) \
        .otherwise(F.lit(0).cast("decimal(19,4)")).cast("decimal(19,4)")
