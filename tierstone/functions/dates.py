"""Calendar expressions used by partitioning, planning and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_months_between(start: Column, end: Column) -> Column:
    """Calendar-month boundaries crossed between two dates.

    Spark's own ``datediff(MONTH, …)`` counts full months instead:
    2019-01-31 to 2019-02-01 is 0 there and 1 here.
    """
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def month_key(year: Column, month: Column) -> Column:
    """``yyyymm`` as an integer; a range on it still prunes partitions."""
    return year * 100 + month


def snapshot_name(run_date: Column, months_back: int) -> Column:
    """Name of the monthly snapshot ``months_back`` months before a run."""
    return F.concat(
        F.lit("TRADES_COLD_SNAP_"),
        F.date_format(F.add_months(run_date, -months_back), "yyyyMM"),
    )


def first_of_month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def next_month(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def shift_months(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def months_in_range(start: dt.date, end: dt.date) -> list[dt.date]:
    """First days of the months from ``start`` to ``end``, both inclusive."""
    months, current = [], first_of_month(start)
    while current <= end:
        months.append(current)
        current = next_month(current)
    return months
