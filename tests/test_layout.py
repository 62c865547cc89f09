"""Plans and layouts: pruning, pushdown, skewed writes, listings, dates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierstone.functions import calendar_months_between
from tierstone.functions.dates import months_in_range, shift_months
from tierstone.plans import analytics, reports
from tierstone.schema import COLUMNS, TRADE_SCHEMA
from tierstone.sources import inventory, scans, writer
from tierstone.sources.storage import build_once, clear_runs, exists, fresh_path, workspace


def plan(df):
    """The physical plan with its filters and schemas in full."""
    with writer.settings(df.sparkSession, maxMetadataStringLength="5000"):
        return df._jdf.queryExecution().executedPlan().toString()


def scanned_partitions(spark, df):
    return df.select(*writer.PARTITION_COLUMNS).distinct().count()


def test_date_window_prunes_partitions(trades):
    window = scans.date_window(trades, dt.date(1998, 3, 10), dt.date(1998, 5, 2))
    filters = plan(window).split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "trade_year" in filters and "199803" in filters
    bare = scans.date_window(trades, dt.date(1998, 3, 10), dt.date(1998, 5, 2), prune=False)
    assert "PartitionFilters: []" in plan(bare)
    assert window.count() == bare.count()


def test_lookup_filters_reach_the_scan(trades):
    assert "PushedFilters: [IsNotNull(trade_id), EqualTo(trade_id,x)]" in plan(
        analytics.point_lookup(trades, "x")
    )
    top = plan(analytics.counterparty_latest(trades, "CP_000078"))
    assert "TakeOrderedAndProject" in top and "EqualTo(counterparty_id" in top


def test_reports_read_only_their_columns(trades):
    schema = plan(analytics.year_class_report(trades, 1998, "FX")).split("ReadSchema: ")[1]
    assert "counterparty_lei" not in schema and "uti" not in schema


def test_a_hot_partition_is_written_by_several_tasks(spark, trades, folder):
    """One partition with a third of the rows and more is split by bytes."""
    skewed = trades.withColumns(
        {
            "trade_year": F.lit(1998),
            "trade_month": F.lit(6),
            "asset_class": F.when(F.pmod(F.xxhash64("trade_id"), F.lit(3)) < 2, "FX").otherwise("LOAN"),
        }
    ).repartition(8)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(writer, "FILE_BYTES", "64k")
        patch.setattr(writer, "SMALLEST_TASK", "16k")
        writer.write_trades(skewed, f"{folder}/table")
    files = inventory.file_inventory(spark, f"{folder}/table").collect()
    assert {f.asset_class: f.files for f in files}["FX"] > 1
    assert scans.read_trades(spark, f"{folder}/table").count() == trades.count()


def test_id_filter_is_written(spark, recent, folder):
    writer.write_trades(recent, f"{folder}/filtered", id_filter=True)
    found = analytics.point_lookup(scans.read_trades(spark, f"{folder}/filtered"), recent.first().trade_id)
    assert found.count() == 1
    plain = f"{folder}/plain"
    writer.write_trades(recent, plain)
    size = lambda path: inventory.data_files(spark, path).agg(F.sum("bytes")).first()[0]
    assert size(f"{folder}/filtered") > size(plain)


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError):
        with writer.settings(spark, shuffle__partitions="77"):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
            raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert int(writer.enough_shuffle_partitions(spark, 100 * 1024**4)) > 2_000_000


def test_a_stored_table_is_built_once(spark, folder):
    calls = []

    def write(path):
        calls.append(path)
        spark.range(3).write.parquet(path)

    first = build_once(spark, f"{folder}/derived", write)
    assert build_once(spark, f"{folder}/derived", write) == first
    assert len(calls) == 1


def test_run_folders_are_new_and_can_be_cleared(spark):
    first, second = fresh_path(spark, "job"), fresh_path(spark, "job")
    assert first != second
    spark.range(1).write.parquet(first)
    assert clear_runs(spark) and not exists(spark, first)


def test_workspace_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert workspace(spark) == (named.rstrip("/") if named else workspace(spark))


def test_columns_are_checked_against_the_rows(spark, recent):
    longer = recent.withColumn("local_currency", F.lit("EURO"))
    results = {r.column_name: r for r in inventory.schema_columns(longer).collect()}
    assert [r.column_name for r in inventory.schema_columns(recent).collect()] == COLUMNS
    assert results["local_currency"].result == "FAIL" and results["local_currency"].longest_value == 4
    assert results["trade_id"].result == "PASS" and results["notional_usd"].numeric_precision == 22


def test_stored_schema_is_the_declared_one(trades):
    assert [(f.name, f.dataType) for f in trades.schema] == [(f.name, f.dataType) for f in TRADE_SCHEMA]


def test_table_details_by_json_path(spark, recent):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_details")
    spark.sql("CREATE TABLE IF NOT EXISTS lake_details.t (a INT) USING parquet")
    try:
        row = inventory.table_details(spark, "lake_details.t", "$.table_name").first()
        assert row.value == "t"
    finally:
        spark.sql("DROP DATABASE lake_details CASCADE")


def test_calendar_months(spark):
    pairs = [("2019-01-31", "2019-02-01", 1), ("2019-01-01", "2019-01-31", 0), ("2019-12-31", "2021-01-01", 13)]
    frame = spark.createDataFrame(pairs, "a string, b string, n int")
    months = calendar_months_between(F.to_date("a"), F.to_date("b"))
    assert all(r.n == r.m for r in frame.withColumn("m", months).collect())


def test_month_lists():
    assert months_in_range(dt.date(2000, 11, 15), dt.date(2001, 2, 1)) == [
        dt.date(2000, 11, 1), dt.date(2000, 12, 1), dt.date(2001, 1, 1), dt.date(2001, 2, 1),
    ]
    assert shift_months(dt.date(2001, 1, 31), -14) == dt.date(1999, 11, 1)


def test_partition_advice_rejects_fine_columns(trades):
    advice = reports.partition_advice(
        trades, {"id": ["trade_id"], "month": ["trade_year", "trade_month"]}
    ).collect()
    assert {r.strategy: r.verdict for r in advice} == {"id": "REDESIGN", "month": "OK"}


def test_pruned_share(spark):
    frame = spark.createDataFrame([(1, 4), (0, 0)], "s bigint, t bigint")
    shares = frame.select(reports.pruned_share(F.col("s"), F.col("t")).alias("p")).collect()
    assert [r.p for r in shares] == [75.0, None]


def test_storage_classes_follow_the_age(spark):
    months = [(2001, 11, "FX", 10), (2001, 9, "FX", 10), (2001, 6, "FX", 10)]
    parts = spark.createDataFrame(months, "trade_year int, trade_month int, asset_class string, bytes bigint")
    as_of = dt.date(2001, 11, 5)
    got = reports.storage_class_report({"WARM": parts, "COLD": parts}, as_of).collect()
    assert [(r.tier, r.storage_class, r.partitions) for r in got] == [
        ("COLD", "GLACIER_IR", 1), ("COLD", "STANDARD", 1), ("COLD", "STANDARD_IA", 1),
        ("WARM", "INTELLIGENT_TIERING", 1), ("WARM", "STANDARD", 2),
    ]
