"""Rule-based classification of cashdesk expense rows (B8-B10) and agent labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: comment patterns (case-insensitive substring match),
# ---- misspellings included on purpose.
AIR_TICKET_PATTERNS = ("Air Ticket", "Flight", "Fly Ticket", "Air Tiket", "Air Tichets", "Air Tickat",
                       "Air Tickent", "Ticket Cost", "Tickets Cost", "Ticket Payment")
DISCOUNT_PLUS_PATTERNS = ("Discount", "Discaunt", "Discont", "Discout", "disccount", "Dsicount", "Difference")
HOTEL_PATTERNS = ("Hotel", "Room Payment", "Acommodation", "Accommodation")

# ---- Fixed values: account ids.
ACC_CASHDESK = 121
ACC_TABLE_CASH = 703
ACC_AGENT_TRANSFER = 802
ACC_PRIVATE_DEPOSIT = 803
ACC_OPERATING_EXPENSE = 641
ACC_AGENT_CREDIT = 153
ACC_LG_DISCOUNT = 151
ACC_SLOT_DISCOUNT = 154
MONEY_ACCOUNTS = (121, 703, 802, 803)
DROP_ACCOUNTS = (121, 703)
EXPENSE_ACCOUNTS = (153, 151, 154, 641)

# ---- Fixed values: the expense-type dimension
# (key, account, direction or None, group, type, sort order).
EXPENSE_TYPES = (
    (1, 641, None, "Operating Expense", "Air Tickets", 1),
    (2, 641, None, "Operating Expense", "Discount+", 2),
    (3, 641, None, "Operating Expense", "Hotel", 3),
    (4, 641, None, "Operating Expense", "Other", 4),
    (5, 153, 1, "Agent Credit", "Agent Out", 5),
    (6, 153, -1, "Agent Credit", "Agent Void", 6),
    (7, 151, None, "Discount", "LG Discount", 7),
    (8, 154, None, "Discount", "Slot Discount", 8),
)

NO_AGENT = "NO AGENT"


def matches_any_sql(text: str, patterns: Sequence[str]) -> str:
    """SQL form of ``matches_any`` over a column name: one expression string."""
    parts = [f"{text} ILIKE '%{p.replace(chr(39), chr(39) * 2)}%'" for p in patterns]
    return "(" + " OR ".join(parts) + ")"


def matches_any(text: Column | str, patterns: Sequence[str]) -> Column:
    """``text ILIKE '%p1%' OR text ILIKE '%p2%' ...``; NULL text gives NULL (not true)."""
    if isinstance(text, str):
        return F.expr(matches_any_sql(text, patterns))
    cond = None
    for p in patterns:
        c = text.ilike(f"%{p}%")
        cond = c if cond is None else (cond | c)
    return cond


def expense_flags_sql(comment: str) -> dict[str, str]:
    """Overlapping category flags of the day fact (B9) as SQL over a column name."""
    air = matches_any_sql(comment, AIR_TICKET_PATTERNS)
    disc = matches_any_sql(comment, DISCOUNT_PLUS_PATTERNS)
    hotel = matches_any_sql(comment, HOTEL_PATTERNS)
    return {"air": air, "discount_plus": disc, "hotel": hotel,
            "other": f"(NOT {air} AND NOT {disc} AND NOT {hotel})"}


def expense_flags(comment: Column | str) -> dict[str, Column]:
    """Overlapping category flags of the day fact (B9): a comment may be both
    air and hotel; 'other' is none of the three."""
    if isinstance(comment, str):
        return {k: F.expr(v) for k, v in expense_flags_sql(comment).items()}
    air = matches_any(comment, AIR_TICKET_PATTERNS)
    disc = matches_any(comment, DISCOUNT_PLUS_PATTERNS)
    hotel = matches_any(comment, HOTEL_PATTERNS)
    return {"air": air, "discount_plus": disc, "hotel": hotel, "other": ~air & ~disc & ~hotel}


def expense_type_key(account: Column, direction: Column, comment: Column) -> Column:
    """First-match expense key 1..8 of the transaction fact (B8); NULL when no rule fits."""
    is_opex = account == ACC_OPERATING_EXPENSE
    return (F.when(is_opex & matches_any(comment, AIR_TICKET_PATTERNS), 1)
            .when(is_opex & matches_any(comment, DISCOUNT_PLUS_PATTERNS), 2)
            .when(is_opex & matches_any(comment, HOTEL_PATTERNS), 3)
            .when(is_opex, 4)
            .when((account == ACC_AGENT_CREDIT) & (direction == 1), 5)
            .when((account == ACC_AGENT_CREDIT) & (direction == -1), 6)
            .when(account == ACC_LG_DISCOUNT, 7)
            .when(account == ACC_SLOT_DISCOUNT, 8))


def agent_label_strict(idagent: Column, name: Column) -> Column:
    """Day-fact label (B11): no agent, empty name or 'NO AGENT' -> 'NO AGENT'."""
    return (F.when(idagent.isNull(), NO_AGENT)
            .when(F.coalesce(name, F.lit("")) == "", NO_AGENT)
            .when(name == NO_AGENT, NO_AGENT)
            .otherwise(name))


def agent_label_loose(idagent: Column, name: Column) -> Column:
    """Transaction-fact label (B12): an empty name stays empty."""
    return F.when(idagent.isNotNull(), F.coalesce(name, F.lit(NO_AGENT))).otherwise(F.lit(NO_AGENT))
