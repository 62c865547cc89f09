"""The consumer queries: yearly class report, lookups, book and regulatory rollups.

``by_date=True`` filters on the trade date alone, as on an unpartitioned table;
``by_date=False`` filters on the partition columns and prunes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.sources.scans import date_window, month_partition, month_window

MONEY = "decimal(32,4)"


def _money(column: str) -> Column:
    return F.sum(column).cast(MONEY)


def _mean(column: str) -> Column:
    """An average as a double, the same on any engine with exact decimal sums."""
    return F.sum(column).cast("double") / F.count(column)


def _years(df: DataFrame, first: int, last: int, by_date: bool) -> DataFrame:
    if by_date:
        return date_window(df, dt.date(first, 1, 1), dt.date(last, 12, 31), closed=True, prune=False)
    return df.where(F.col("trade_year").between(first, last))


def year_class_report(
    df: DataFrame, year: int, asset_class: str, by_date: bool = False
) -> DataFrame:
    """Per day of one year and class: notional, trades, price, counterparties."""
    rows = _years(df, year, year, by_date).where(F.col("asset_class") == asset_class)
    return (
        rows.groupBy("trade_date")
        .agg(
            _money("notional_usd").alias("total_notional"),
            F.count(F.lit(1)).alias("trade_count"),
            _mean("price").alias("avg_price"),
            F.count_distinct("counterparty_id").alias("unique_counterparties"),
        )
        .orderBy("trade_date")
    )


def point_lookup(df: DataFrame, trade_id: str, trade_date: dt.date | None = None) -> DataFrame:
    """One trade by id; a known trade date confines the search to its month."""
    if trade_date is not None:
        df = month_partition(df, trade_date.year, trade_date.month)
    return df.select("*").where(F.col("trade_id") == trade_id)


def book_month_report(df: DataFrame, year: int, month: int, by_date: bool = False) -> DataFrame:
    """Gross notional of one month by book, class and direction, largest first."""
    rows = month_window(df, year, month) if by_date else month_partition(df, year, month)
    return (
        rows.groupBy("book_id", "asset_class", "direction")
        .agg(
            _money("notional_usd").alias("gross_notional"),
            F.count(F.lit(1)).alias("trade_count"),
            F.min("trade_timestamp").alias("first_trade"),
            F.max("trade_timestamp").alias("last_trade"),
        )
        .orderBy(F.desc("gross_notional"), "book_id", "asset_class", "direction")
    )


def cross_year_report(df: DataFrame, first: int, last: int, by_date: bool = False) -> DataFrame:
    """Reportable trades of several years by year, class and entity."""
    year = F.year("trade_date") if by_date else F.col("trade_year")
    return (
        _years(df, first, last, by_date)
        .where(F.col("mifid_flag"))
        .groupBy(year.alias("trade_year"), "asset_class", "entity_id")
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            _money("notional_usd").alias("total_notional"),
            F.count_distinct("uti").alias("uti_count"),
        )
        .orderBy("trade_year", "asset_class", "entity_id")
    )


def counterparty_latest(df: DataFrame, counterparty_id: str, limit: int = 1000) -> DataFrame:
    """The newest trades of one counterparty; the id breaks ties."""
    return (
        df.where(F.col("counterparty_id") == counterparty_id)
        .orderBy(F.desc("trade_timestamp"), "trade_id")
        .limit(limit)
        .select("trade_id", "trade_date", "asset_class", "notional_usd", "trade_status")
    )
