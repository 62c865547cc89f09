"""Test relations derived from the trade history: stale tiers and defects.

Every relation is made from the whole history. The hex digits of the trade id
decide which rows are late or carry a defect; they never reduce what a query
reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.schema import COLUMNS
from tierstone.sources.scans import date_window

# Parameters of the queries.
AS_OF = dt.date(2001, 11, 5)
FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2001, 11, 30)
YEAR, MONTH = 1998, 6
ASSET_CLASS = "FX"
FIRST_YEAR, LAST_YEAR = 1996, 1998
FAILING_YEAR = 1997
COUNTERPARTY = "CP_000078"
TRADE_ID, TRADE_DATE = "000090ed5ad646462add6cf05ef2eeee", dt.date(1995, 12, 20)


def _starts(prefix: str) -> Column:
    return F.col("trade_id").startswith(prefix)


def _days_before(days: int) -> dt.date:
    return AS_OF - dt.timedelta(days=days)


def stale_tiers(trades: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tiers as they stand before a promotion that is twenty days overdue.

    A few old trades arrived late and still sit in hot, and a few hot trades
    were already copied to warm by an earlier run.
    """
    hot_from, warm_from, repeated_to = _days_before(50), _days_before(110), _days_before(30)
    old = date_window(trades, end=warm_from)
    late = old.where(_starts("ff"))
    repeated = date_window(trades, hot_from, repeated_to).where(_starts("f"))
    return (
        date_window(trades, hot_from).unionByName(late),
        date_window(trades, warm_from, hot_from).unionByName(repeated),
        old.where(~_starts("ff")),
    )


def _change(df: DataFrame, digit: str, column: str, value: Column) -> DataFrame:
    changed = F.when(_starts(digit), value).otherwise(F.col(column))
    return df.withColumn(column, changed.cast(df.schema[column].dataType)).select(*COLUMNS)


def defective(trades: DataFrame, name: str) -> DataFrame:
    """A copy of the history with one kind of defect; ``clean`` has none."""
    if name == "clean":
        return trades
    if name == "bad_0":
        return trades.where(~_starts("0"))
    if name == "bad_1":
        return trades.unionByName(trades.where(_starts("1")))
    if name == "bad_2":
        return _change(trades, "2", "direction", F.lit("HOLD"))
    if name == "bad_3":
        return _change(trades, "3", "notional_usd", F.col("notional_usd") + 1)
    if name == "bad_4":
        return _change(trades, "4", "notional_usd", F.lit(None))
    if name == "bad_5":
        return _change(trades, "5", "trade_month", F.col("trade_month") % 12 + 1)
    if name == "bad_6":
        return _change(trades, "6", "notional_usd", -F.col("notional_usd"))
    if name == "bad_7":
        return _change(trades, "7", "trade_date", F.date_add("trade_date", 3650))
    if name == "bad_class":
        return trades.where(F.col("asset_class") != "CRYPTO")
    if name == "bad_empty":
        return trades.where(F.col("trade_year") < FIRST_DAY.year)
    if name == "bad_year":
        return trades.where(F.col("trade_year") != FAILING_YEAR)
    if name == "bad_id":
        return _change(trades, "8", "trade_id", F.lit(None))
    raise ValueError(name)


DEFECTS = ["bad_0", "bad_1", "bad_2", "bad_3", "bad_4", "bad_5", "bad_6", "bad_7", "bad_class"]
