"""Exact decimal arithmetic helpers.

Spark sizes the result of a decimal product as ``p1 + p2 + 1`` digits; past 38
digits it trims the scale to 6 and rounds.  A four-factor product of
DECIMAL(19,4) values therefore loses digits before the final rounding (the
theoretical win 0.0266 x 0.6237 x 30 x 87.9133 would come out 43.7555 instead
of 43.7556).  Narrowing each operand to the digits it usually holds keeps the
full product exact.  When an operand does not fit the narrow type, the product
is taken over the full types instead: Spark keeps six of its digits after the
point, and the result is rounded from those.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC = "decimal(19,4)"

# Usual operand ranges of the theoretical-win product (result DECIMAL(38,12)).
ADT_OPERAND_TYPES = ("decimal(9,4)", "decimal(9,4)", "decimal(6,0)", "decimal(11,4)")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def adt_product(multiplier: Column | str, hours: Column | str, hands: Column | str,
                avg_bet: Column | str) -> Column:
    """``multiplier * hours * hands * avg_bet`` rounded HALF_UP to 4 digits;
    NULL when any operand is NULL (B19)."""
    operands = [_c(x) for x in (multiplier, hours, hands, avg_bet)]
    narrow = [x.try_cast(t) for x, t in zip(operands, ADT_OPERAND_TYPES)]
    # a narrowed operand must keep its value, not only its range
    fits = F.lit(True)
    for x, n in zip(operands, narrow):
        fits = fits & (n.cast(DEC) == x.cast(DEC))
    wide = [x.cast(DEC) for x in operands]
    return F.when(fits, (narrow[0] * narrow[1] * narrow[2] * narrow[3]).cast(DEC)).otherwise(
        ((wide[0] * wide[1]) * (wide[2] * wide[3])).cast(DEC))


def avg_half_up(total: Column, count: Column, scale: int = 4) -> Column:
    """Average as ``sum / count`` rounded once, HALF_UP, to ``scale`` digits.

    ``avg()`` of a DECIMAL(19,4) is typed DECIMAL(23,8) and would round twice;
    the quotient here carries 13 digits, so the final rounding is exact.
    NULL when there are no rows."""
    return F.when(count > 0, total / count).cast(f"decimal({15 + scale},{scale})")
