from tierstone.operators.joins import absent_from, newest_versions
from tierstone.operators.tiers import (
    Promotion,
    due_duplicates,
    promote_tiers,
    split_tiers,
    tier_summary,
    unified_trades,
)

__all__ = [
    "Promotion",
    "absent_from",
    "due_duplicates",
    "newest_versions",
    "promote_tiers",
    "split_tiers",
    "tier_summary",
    "unified_trades",
]
