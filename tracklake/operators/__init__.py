from .asof import asof_join, disjoint_versions
from .dedup import drop_repeats, keep_first, latest_rows
from .incremental import high_water_mark, late_rows, merge_by_key, merge_rows, single_value, since, sync_schema
from .joins import interval_join, join_null_safe, lookup_join
from .load import field_or_null, load_tolerant
from .match import nearest_match
from .quality import Check, check_report, violations
from .ranking import dense_rank_within, next_within, previous_within
from .scd2 import final_changes, user_history, user_versions

__all__ = [
    "Check",
    "asof_join",
    "check_report",
    "dense_rank_within",
    "disjoint_versions",
    "drop_repeats",
    "field_or_null",
    "final_changes",
    "high_water_mark",
    "interval_join",
    "join_null_safe",
    "keep_first",
    "late_rows",
    "latest_rows",
    "load_tolerant",
    "lookup_join",
    "merge_by_key",
    "merge_rows",
    "nearest_match",
    "next_within",
    "previous_within",
    "since",
    "single_value",
    "sync_schema",
    "user_history",
    "user_versions",
    "violations",
]
