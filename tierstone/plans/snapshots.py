"""Monthly point-in-time copies of the cold table and their retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.functions.dates import shift_months, snapshot_name
from tierstone.sources.scans import read_trades
from tierstone.sources.storage import build_once, delete, list_names
from tierstone.sources.writer import copy_trades

PREFIX = "TRADES_COLD_SNAP_"
KEPT = 13


def _name(month: dt.date) -> str:
    return f"{PREFIX}{month:%Y%m}"


def monthly_snapshot(
    spark: SparkSession, cold: DataFrame, root: str, as_of: dt.date, keep: int = KEPT
) -> str:
    """Copy the cold tier as last month's snapshot and drop those past retention.

    Everything older than the retained months goes, so a missed run heals
    itself. The copy is written aside and renamed, and has no shuffle.
    """
    created = _name(shift_months(as_of, -1))
    stored = build_once(spark, f"{root}/{created}", lambda path: copy_trades(cold, path))
    if stored != f"{root}/{created}":
        raise RuntimeError(f"{created} was taken by another run; this run's copy is {stored}")
    oldest = _name(shift_months(as_of, -keep))
    dropped = sorted(
        name
        for name in list_names(spark, root)
        if name.startswith(PREFIX) and "-" not in name and name < oldest
    )
    for name in dropped:
        delete(spark, f"{root}/{name}")
    return f"Created: {created} | Dropped: {', '.join(dropped) or 'none'}"


def as_of_month(spark: SparkSession, root: str, yyyymm: str) -> DataFrame:
    """The table as it was at the end of a month."""
    return read_trades(spark, f"{root}/{PREFIX}{yyyymm}")


def point_in_time(snapshot: DataFrame, start: dt.date, end: dt.date, asset_class: str) -> DataFrame:
    """Trades of a date range and class as a snapshot saw them."""
    key = F.col("trade_year")
    return snapshot.where(
        key.between(start.year, end.year)
        & F.col("trade_date").between(F.lit(start), F.lit(end))
        & (F.col("asset_class") == asset_class)
    ).select("trade_id", "notional_usd", "trade_status")


def snapshot_names(run_date: Column) -> list[Column]:
    """Names a run creates and drops, and the message it returns."""
    created, dropped = snapshot_name(run_date, 1), snapshot_name(run_date, KEPT + 1)
    message = F.concat(F.lit("Created: "), created, F.lit(" | Dropped: "), dropped)
    return [created.alias("snap_name"), dropped.alias("drop_name"), message.alias("message")]


def retention(registry: DataFrame, as_of: dt.date, keep: int = KEPT, metadata_days: int = 365) -> DataFrame:
    """Which registered objects have expired.

    ``registry`` has ``name, kind, created``: a snapshot expires by the month
    in its name, metadata by its age in days.
    """
    oldest = _name(shift_months(as_of, -keep))
    expired = F.when(F.col("kind") == "SNAPSHOT", F.col("name") < oldest).otherwise(
        F.datediff(F.lit(as_of), F.col("created")) > metadata_days
    )
    return registry.select(
        "name", "kind", "created", F.when(expired, "DROP").otherwise("KEEP").alias("action")
    )
