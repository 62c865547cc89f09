"""Reading trades: whole tiers, date windows and partitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.functions.dates import month_key, next_month
from tierstone.schema import COLUMNS, LEGACY_SCHEMA, TRADE_SCHEMA
from tierstone.sources import versions
from tierstone.sources.storage import exists


def with_partition_columns(df: DataFrame) -> DataFrame:
    """Materialise the partition columns from the trade date, in schema order."""
    return df.withColumns(
        {"trade_year": F.year("trade_date"), "trade_month": F.month("trade_date")}
    ).select(*COLUMNS)


def empty_trades(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TRADE_SCHEMA)


def read_trades(
    spark: SparkSession,
    path: str,
    version: versions.Version | None = None,
    folders: Iterable[str] | None = None,
) -> DataFrame:
    """A partitioned trade table; a table not written yet reads as empty.

    Of a table with versions the newest is read, or the given one: all of it stays as it is
    while it is read. ``folders`` are the partition folders to read, all by default.
    """
    found = versions.home(spark, path)
    if found is None:
        if not exists(spark, path):
            return empty_trades(spark)
        if folders is not None:
            places = [versions.Place("", f, f) for f in folders]
            return read_places(spark, path, places)
        return spark.read.schema(TRADE_SCHEMA).parquet(path).select(*COLUMNS)
    root, table = found
    version = version or versions.load(spark, root)
    return read_places(spark, path, version.of(table, folders))


def read_places(spark: SparkSession, path: str, places: list[versions.Place]) -> DataFrame:
    """The rows of some places of the table at ``path``."""
    frames = [
        spark.read.schema(TRADE_SCHEMA).option("basePath", path)
        .parquet(*[f"{path}/{p.at}" for p in own]).select(*COLUMNS)
        for own in place_groups(places)
    ]
    return reduce(DataFrame.unionByName, frames) if frames else empty_trades(spark)


def place_groups(places: list[versions.Place]) -> list[list[versions.Place]]:
    """Places that can be read together: runs have a folder level more."""
    groups = [p for p in places if not p.own_run], [p for p in places if p.own_run]
    return [g for g in groups if g]


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """The unpartitioned source; partition columns are computed on read."""
    return with_partition_columns(spark.read.schema(LEGACY_SCHEMA).parquet(path))


def scan_tier(df: DataFrame) -> DataFrame:
    """All declared columns, by name."""
    return df.select(*COLUMNS)


def date_window(
    df: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    closed: bool = False,
    prune: bool = True,
) -> DataFrame:
    """Trades with ``start <= trade_date < end`` (``<= end`` when ``closed``).

    A range on ``trade_date`` alone prunes no partitions, so the partition
    range it implies is added. That presumes partition columns that agree with
    the date; turn ``prune`` off to look for rows where they do not.
    """
    key = month_key(F.col("trade_year"), F.col("trade_month"))
    if start is not None:
        df = df.where(F.col("trade_date") >= F.lit(start))
        if prune:
            df = df.where(
                (F.col("trade_year") >= start.year) & (key >= start.year * 100 + start.month)
            )
    if end is not None:
        last = end if closed else end - dt.timedelta(days=1)
        df = df.where(F.col("trade_date") <= F.lit(last))
        if prune:
            df = df.where((F.col("trade_year") <= last.year) & (key <= last.year * 100 + last.month))
    return df


def month_window(df: DataFrame, year: int, month: int) -> DataFrame:
    """One month of an unpartitioned source, by date only."""
    start = dt.date(year, month, 1)
    return date_window(df, start, next_month(start), prune=False)


def month_partition(df: DataFrame, year: int, month: int) -> DataFrame:
    return df.where((F.col("trade_year") == year) & (F.col("trade_month") == month))


def in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))
