from tierstone.sources.scans import (
    date_window,
    empty_trades,
    month_partition,
    read_legacy,
    read_trades,
    scan_tier,
    with_partition_columns,
)
from tierstone.sources.writer import append_trades, replace_partitions, write_trades

__all__ = [
    "append_trades",
    "date_window",
    "empty_trades",
    "month_partition",
    "read_legacy",
    "read_trades",
    "replace_partitions",
    "scan_tier",
    "with_partition_columns",
    "write_trades",
]
