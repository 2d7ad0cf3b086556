"""Generic DataFrame operators (usable on any table with the named columns)."""

from .asof import agent_at, asof_last
from .dedupe import latest_per_key, upsert_last_wins
from .keys import assert_key, assert_not_null, key_violations, orphans, reference_check
from .overlap import overlap_condition, overlap_left_join, overlap_left_join_bucketed
from .pool import clean_drop, hour_chunk, pool_trace
from .reconcile import multiset_difference
from .scan import carry_last, chunked_row_number, max_prefix_sum, running_sum

__all__ = [
    "agent_at", "asof_last", "latest_per_key", "upsert_last_wins", "assert_key", "assert_not_null",
    "key_violations", "orphans", "reference_check", "overlap_condition", "overlap_left_join",
    "overlap_left_join_bucketed", "clean_drop", "hour_chunk", "pool_trace", "multiset_difference",
    "carry_last", "chunked_row_number", "max_prefix_sum", "running_sum",
]
