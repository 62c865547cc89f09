from tierstone.functions.dates import (
    calendar_months_between,
    month_key,
    snapshot_name,
)
from tierstone.functions.hashing import row_hash, sample_order
from tierstone.functions.verdicts import same_within, verdict

__all__ = [
    "calendar_months_between",
    "month_key",
    "row_hash",
    "same_within",
    "sample_order",
    "snapshot_name",
    "verdict",
]
