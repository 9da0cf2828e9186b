"""DataFrame operators the plans are built from."""

from wayfare.operators.incremental import after_high_water, upsert_latest
from wayfare.operators.keyed import duplicate_keys, latest_by, left_lookup, update_flags
from wayfare.operators.rows import dealt_by, to_long, top_k, union_all

__all__ = [
    "after_high_water",
    "dealt_by",
    "duplicate_keys",
    "latest_by",
    "left_lookup",
    "to_long",
    "top_k",
    "union_all",
    "update_flags",
    "upsert_latest",
]
