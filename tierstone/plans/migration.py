"""Snapshot-first migration of months into the partitioned cold table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.functions.dates import month_key, months_in_range, next_month
from tierstone.operators.validation import validate_all_partitions
from tierstone.plans.compaction import compact
from tierstone.schema import COLUMNS, MIGRATION_LOG_SCHEMA, PARTITION_COLUMNS
from tierstone.sources.scans import date_window, read_trades, with_partition_columns
from tierstone.sources.storage import delete, exists
from tierstone.sources.writer import append_laid_out as append_trades
from tierstone.sources.writer import copy_trades, drop_partitions, gathered_copy, laid_out

SOURCE_TABLE = "TRADES_COLD_LEGACY"
TARGET_TABLE = "TRADES_COLD"


@dataclass(frozen=True)
class MigrationPaths:
    root: str

    @property
    def target(self) -> str:
        return f"{self.root}/trades_cold"

    @property
    def log(self) -> str:
        return f"{self.root}/migration_log"

    def snapshot(self, month: dt.date) -> str:
        return f"{self.root}/MIGRATION_SNAP_{month:%Y%m}"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], MIGRATION_LOG_SCHEMA)
    return spark.read.schema(MIGRATION_LOG_SCHEMA).parquet(path)


def log_rows(months: DataFrame) -> DataFrame:
    """Audit rows from ``trade_year, trade_month, rows_migrated, status, notes``."""
    start = F.make_date("trade_year", "trade_month", F.lit(1))
    return months.select(
        F.expr("uuid()").alias("migration_run_id"),
        F.lit(SOURCE_TABLE).alias("source_table"),
        F.lit(TARGET_TABLE).alias("target_table"),
        start.alias("partition_start"),
        F.last_day(start).alias("partition_end"),
        F.col("rows_migrated").cast("bigint").alias("rows_migrated"),
        F.current_timestamp().cast("timestamp_ntz").alias("migration_ts"),
        "status",
        "notes",
    )


def month_plan(
    source: DataFrame,
    log: DataFrame,
    start: dt.date,
    end: dt.date,
    resume_from: dt.date | None = None,
) -> DataFrame:
    """What a range migration would do, month by month, without doing it."""
    first = max(start, resume_from) if resume_from else start
    spark = source.sparkSession
    months = spark.range(1).select(
        F.explode(
            F.sequence(
                F.trunc(F.lit(first), "month"), F.trunc(F.lit(end), "month"), F.expr("INTERVAL 1 MONTH")
            )
        ).alias("partition_start")
    )
    window = date_window(source, first.replace(day=1), next_month(end), prune=False)
    counted = window.groupBy(F.trunc("trade_date", "month").alias("partition_start")).agg(
        F.count(F.lit(1)).alias("source_rows")
    )
    done = (
        log.where(F.col("status") == "COMPLETED")
        .select("partition_start", F.lit(True).alias("done"))
        .distinct()
    )
    return (
        months.join(counted, "partition_start", "left")
        .join(done, "partition_start", "left")
        .select(
            "partition_start",
            F.last_day("partition_start").alias("partition_end"),
            F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
            F.when(F.col("done"), "SKIP").otherwise("MIGRATE").alias("action"),
        )
        .orderBy("partition_start")
    )


def _in_months(df: DataFrame, months: list[dt.date]) -> DataFrame:
    """Rows of the listed months: a date range, narrowed to the months in it."""
    window = date_window(df, months[0], next_month(months[-1]))
    keys = [m.year * 100 + m.month for m in months]
    return window.where(month_key(F.col("trade_year"), F.col("trade_month")).isin(keys))


def _completed_months(spark: SparkSession, path: str) -> set[dt.date]:
    rows = (
        read_log(spark, path)
        .where(F.col("status") == "COMPLETED")
        .select("partition_start")
        .distinct()
        .collect()
    )
    return {row[0] for row in rows}


def _outcomes(
    spark: SparkSession, snapshot: DataFrame, target: DataFrame, months: list[dt.date], validate: bool
) -> DataFrame:
    """Rows migrated and status per month; a month without rows completes with 0."""
    wanted = spark.createDataFrame(
        [(m.year, m.month) for m in months], "trade_year int, trade_month int"
    )
    if validate:
        checked = validate_all_partitions(snapshot, target).select(
            "trade_year", "trade_month", F.col("target_rows").alias("rows_migrated"), "result",
            F.concat(
                F.lit("source rows "), F.col("source_rows"), F.lit(", target rows "), F.col("target_rows")
            ).alias("detail"),
        )
    else:
        checked = target.groupBy("trade_year", "trade_month").agg(
            F.count(F.lit(1)).alias("rows_migrated")
        ).select("*", F.lit("PASS").alias("result"), F.lit(None).cast("string").alias("detail"))
    failed = F.coalesce(F.col("result") != "PASS", F.lit(False))
    return wanted.join(checked, ["trade_year", "trade_month"], "left").select(
        "trade_year",
        "trade_month",
        F.coalesce("rows_migrated", F.lit(0)).alias("rows_migrated"),
        F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"),
        F.when(failed, F.concat(F.lit("validation failed: "), F.col("detail"))).alias("notes"),
    )


def migrate_months(
    spark: SparkSession,
    source: DataFrame,
    paths: MigrationPaths,
    months: list[dt.date],
    validate: bool = True,
    copy_snapshot: bool = True,
) -> bool:
    """Migrate a set of months as one job; True when all of them are complete.

    The source is copied first and only the copy is migrated and validated, so
    writes that reach the source meanwhile cannot make the counts differ. The copy
    lies in partition folders, from which the target is written without a shuffle.
    ``copy_snapshot=False`` trusts the frame's own file list instead, for a
    source whose files are never rewritten. Months already completed in the log
    are skipped; leftovers of a failed attempt are dropped before the insert.
    """
    done = _completed_months(spark, paths.log)
    pending = [m for m in sorted(months) if m not in done]
    if not pending:
        return True
    snapshot = _in_months(with_partition_columns(source), pending)
    copy = paths.snapshot(pending[0])
    if copy_snapshot:
        delete(spark, copy)
        copy_trades(snapshot, copy)
        snapshot = read_trades(spark, copy)
        rows = gathered_copy(spark, copy)
    else:
        rows = laid_out(snapshot, PARTITION_COLUMNS)
    drop_partitions(
        spark, paths.target, [f"trade_year={m.year}/trade_month={m.month}" for m in pending]
    )
    append_trades(rows, paths.target)
    target = _in_partitions(read_trades(spark, paths.target), pending)
    outcomes = _outcomes(spark, snapshot, target, pending, validate)
    log_rows(outcomes).coalesce(1).write.mode("append").parquet(paths.log)
    complete = set(pending) <= _completed_months(spark, paths.log)
    if complete and copy_snapshot:
        delete(spark, copy)
    return complete


def _in_partitions(df: DataFrame, months: list[dt.date]) -> DataFrame:
    """Partitions of the listed months, whatever the dates inside them."""
    picked = reduce(
        lambda a, b: a | b,
        [
            (F.col("trade_year") == year)
            & F.col("trade_month").isin([m.month for m in group])
            for year, group in groupby(months, key=lambda m: m.year)
        ],
    )
    return df.where(picked)


def migrate_range(
    spark: SparkSession,
    source: DataFrame,
    paths: MigrationPaths,
    start: dt.date,
    end: dt.date,
    resume_from: dt.date | None = None,
    validate: bool = True,
    dry_run: bool = False,
    copy_snapshot: bool = True,
    compact_years: bool = True,
    months_per_job: int = 12,
) -> DataFrame:
    """Migrate a range of months in order; stops after the first failure.

    Months are grouped by year, up to ``months_per_job`` in one Spark job, and
    each year is compacted once its months are in. Returns the log, or the plan
    for a dry run.
    """
    first = max(start, resume_from) if resume_from else start
    if dry_run:
        return month_plan(source, read_log(spark, paths.log), start, end, resume_from)
    for year, group in groupby(months_in_range(first, end), key=lambda m: m.year):
        months = list(group)
        jobs = [months[i : i + months_per_job] for i in range(0, len(months), months_per_job)]
        if not all(
            migrate_months(spark, source, paths, job, validate, copy_snapshot) for job in jobs
        ):
            break
        if compact_years:
            compact(spark, paths.target, [year])
    return read_log(spark, paths.log)


def migrated(spark: SparkSession, paths: MigrationPaths) -> DataFrame:
    return read_trades(spark, paths.target).select(*COLUMNS)
