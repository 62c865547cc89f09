"""Tier membership, the unified view, and promotion between tiers."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.operators.joins import new_trades
from tierstone.schema import COLUMNS
from tierstone.sources.scans import date_window, with_partition_columns

HOT_DAYS = 30
WARM_DAYS = 90


def cutoffs(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First hot day and first warm day."""
    return as_of - dt.timedelta(days=HOT_DAYS), as_of - dt.timedelta(days=WARM_DAYS)


def split_tiers(trades: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A whole history split into hot, warm and cold by age."""
    hot_from, warm_from = cutoffs(as_of)
    return (
        date_window(trades, hot_from),
        date_window(trades, warm_from, hot_from),
        date_window(trades, end=warm_from),
    )


def unified_trades(hot: DataFrame, warm: DataFrame, cold: DataFrame) -> DataFrame:
    """All tiers as one relation; a filter on ``storage_tier`` drops the other tiers.

    The hot tier always computes its partition columns from the trade date.
    """
    tiers = [(with_partition_columns(hot), "HOT"), (warm, "WARM"), (cold, "COLD")]
    tagged = [df.select(*COLUMNS, F.lit(tier).alias("storage_tier")) for df, tier in tiers]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def tier_summary(unified: DataFrame) -> DataFrame:
    return unified.groupBy("storage_tier").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("trade_date").alias("min_date"),
        F.max("trade_date").alias("max_date"),
    ).orderBy("storage_tier")


def older_than(cutoff: dt.date) -> Column:
    return F.col("trade_date") < F.lit(cutoff)


def without(df: DataFrame, condition: Column) -> DataFrame:
    """What a DELETE leaves behind: rows where the condition is false or NULL."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def due_duplicates(hot: DataFrame, as_of: dt.date) -> DataFrame:
    """Ids that occur more than once among the rows due for promotion."""
    due = hot.where(F.col("trade_date") < F.date_sub(F.lit(as_of), HOT_DAYS))
    return (
        due.groupBy("trade_id")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


class Promotion:
    """One promotion run as frames: aged rows move hot to warm to cold.

    Rows already in the next tier are not moved twice. Step two reads the warm
    tier after step one has filled it. Nothing is computed before it is asked for.
    """

    def __init__(self, hot: DataFrame, warm: DataFrame, cold: DataFrame, as_of: dt.date):
        self.hot_from, self.warm_from = cutoffs(as_of)
        self._hot = with_partition_columns(hot)
        self._warm = warm.select(*COLUMNS)
        self._cold = cold.select(*COLUMNS)

    @cached_property
    def to_warm(self) -> DataFrame:
        return new_trades(self._hot.where(older_than(self.hot_from)), self._warm)

    @cached_property
    def to_cold(self) -> DataFrame:
        return new_trades(self._filled().where(older_than(self.warm_from)), self._cold)

    def _filled(self) -> DataFrame:
        return self._warm.unionByName(self.to_warm)

    @property
    def hot(self) -> DataFrame:
        return without(self._hot, older_than(self.hot_from))

    @property
    def warm(self) -> DataFrame:
        return without(self._filled(), older_than(self.warm_from))

    @property
    def cold(self) -> DataFrame:
        return self._cold.unionByName(self.to_cold)

    def report(self) -> DataFrame:
        def line(df: DataFrame, step: str) -> DataFrame:
            return df.agg(F.count(F.lit(1)).alias("rows_promoted")).select(
                F.lit(step).alias("tier"), "rows_promoted", F.lit("SUCCESS").alias("status")
            )

        return line(self.to_warm, "HOT→WARM").unionByName(line(self.to_cold, "WARM→COLD"))


def promote_tiers(hot: DataFrame, warm: DataFrame, cold: DataFrame, as_of: dt.date) -> Promotion:
    return Promotion(hot, warm, cold, as_of)
