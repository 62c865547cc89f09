"""Migration, compaction, snapshots on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierstone.operators.tiers import split_tiers
from tierstone.plans import compaction, migration, snapshots
from tierstone.schema import LEGACY_COLUMNS, PARTITION_COLUMNS
from tierstone.sources.inventory import data_files, file_inventory
from tierstone.sources.scans import read_legacy, read_trades
from tierstone.sources.storage import exists
from tierstone.sources.writer import content_checksum, replace_partitions, write_by_month
from tierstone.workload.fixtures import AS_OF

START, END = dt.date(2001, 7, 1), dt.date(2001, 11, 30)


@pytest.fixture
def source(spark, recent, folder):
    path = f"{folder}/legacy"
    write_by_month(recent.select(*LEGACY_COLUMNS), path)
    return read_legacy(spark, path)


@pytest.fixture
def paths(folder):
    return migration.MigrationPaths(f"{folder}/lake")


def statuses(log):
    return {r.partition_start: (r.status, r.rows_migrated) for r in log.collect()}


@pytest.mark.parametrize("copy", [True, False])
def test_range_migration_moves_everything(spark, recent, source, paths, copy):
    log = migration.migrate_range(spark, source, paths, START, END, copy_snapshot=copy)
    assert content_checksum(migration.migrated(spark, paths)) == content_checksum(recent)
    assert len(statuses(log)) == 5 and log.count() == 5
    assert {s for s, _ in statuses(log).values()} == {"COMPLETED"}
    assert log.agg(F.sum("rows_migrated")).first()[0] == recent.count()
    assert log.select("migration_run_id").distinct().count() == 5
    assert not exists(spark, paths.snapshot(START))


def test_completed_months_are_skipped(spark, source, paths):
    migration.migrate_range(spark, source, paths, START, dt.date(2001, 8, 31))
    log = migration.migrate_range(spark, source, paths, START, dt.date(2001, 9, 30))
    assert log.count() == 3


def test_failed_month_is_logged_and_redone(spark, recent, source, paths, monkeypatch):
    """A month that fails validation stops the range; a rerun starts it afresh."""
    monkeypatch.setattr(
        migration, "append_trades", _append_losing_rows(migration.append_trades)
    )
    log = migration.migrate_range(spark, source, paths, START, END, months_per_job=2)
    assert {s for s, _ in statuses(log).values()} == {"FAILED"}
    assert log.count() == 2 and "validation failed" in log.first().notes
    assert exists(spark, paths.snapshot(START))
    monkeypatch.undo()
    migration.migrate_range(spark, source, paths, START, END, months_per_job=2)
    assert content_checksum(migration.migrated(spark, paths)) == content_checksum(recent)


def _append_losing_rows(append):
    return lambda df, path: append(df.where("asset_class <> 'FX'"), path)


def test_writes_during_the_migration_do_not_count(spark, recent, source, paths, folder, monkeypatch):
    """Late rows reach the source between snapshot and validation."""
    append = migration.append_trades

    def append_with_late_arrivals(df, path):
        late = recent.limit(50).withColumn("trade_id", F.concat(F.lit("late"), F.col("trade_id")))
        late.select(*LEGACY_COLUMNS).write.mode("append").parquet(f"{folder}/legacy")
        return append(df, path)

    monkeypatch.setattr(migration, "append_trades", append_with_late_arrivals)
    log = migration.migrate_range(spark, source, paths, START, END)
    assert {s for s, _ in statuses(log).values()} == {"COMPLETED"}
    live = read_legacy(spark, f"{folder}/legacy")
    assert live.count() == recent.count() + 50
    from tierstone.operators.joins import late_arrivals

    late = late_arrivals(live, migration.migrated(spark, paths))
    assert late.agg(F.sum("late_rows")).first()[0] == 50


def test_dry_run_writes_nothing(spark, source, paths):
    plan = migration.migrate_range(
        spark, source, paths, START, END, resume_from=dt.date(2001, 8, 1), dry_run=True
    ).collect()
    assert [r.partition_start.month for r in plan] == [8, 9, 10, 11]
    assert {r.action for r in plan} == {"MIGRATE"}
    assert not exists(spark, paths.target) and not exists(spark, paths.log)


def test_compaction_merges_small_files(spark, recent, folder):
    path = f"{folder}/fragments"
    for part in range(3):
        slice_ = recent.where(F.pmod(F.xxhash64("trade_id"), F.lit(3)) == part)
        slice_.coalesce(1).write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)
    before = file_inventory(spark, path).agg(F.sum("files")).first()[0]
    rewritten = compaction.compact(spark, path, [2001])
    after = file_inventory(spark, path).agg(F.max("files"), F.sum("files")).first()
    assert rewritten > 0 and after[0] == 1 and after[1] < before
    assert content_checksum(read_trades(spark, path)) == content_checksum(recent)
    assert compaction.compact(spark, path, [2001]) == 0


def test_a_large_partition_gets_several_files(spark, recent, folder, monkeypatch):
    path = f"{folder}/skewed"
    hot = recent.withColumns({"asset_class": F.lit("FX"), "trade_month": F.lit(6), "trade_year": F.lit(2001)})
    for _ in range(2):
        hot.repartition(4, "trade_id").write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)
    size = data_files(spark, path).agg(F.sum("bytes")).first()[0]
    monkeypatch.setattr(compaction, "MB", 1024)
    target_kb = size // 1024 // 3
    assert compaction.compact(spark, path, [2001], min_mb=target_kb, target_mb=target_kb) == 1
    files = data_files(spark, path)
    assert 3 <= files.count() <= 4
    assert read_trades(spark, path).count() == 2 * recent.count()


def test_replacing_refuses_rows_of_other_partitions(spark, recent, folder):
    path = f"{folder}/table"
    recent.write.partitionBy(*PARTITION_COLUMNS).parquet(path)
    with pytest.raises(ValueError):
        replace_partitions(
            spark, recent, path, ["trade_year=2001/trade_month=7/asset_class=FX"]
        )
    assert read_trades(spark, path).count() == recent.count()


def test_thirteen_snapshots_are_kept(spark, recent, folder):
    _, _, cold = split_tiers(recent, AS_OF)
    cold = cold.limit(20)
    message = ""
    for month in range(15):
        run = dt.date(2000 + (8 + month) // 12, (8 + month) % 12 + 1, 1)
        message = snapshots.monthly_snapshot(spark, cold, folder, run)
    names = [n for n in snapshots.list_names(spark, folder) if n.startswith(snapshots.PREFIX)]
    assert len(names) == 13
    assert message == "Created: TRADES_COLD_SNAP_200110 | Dropped: TRADES_COLD_SNAP_200009"


def test_point_in_time_ignores_later_changes(spark, recent, folder):
    _, _, cold = split_tiers(recent, AS_OF)
    snapshots.monthly_snapshot(spark, cold, f"{folder}/snaps", AS_OF)
    table = snapshots.as_of_month(spark, f"{folder}/snaps", "200110")
    got = snapshots.point_in_time(table, START, END, "FX")
    assert got.columns == ["trade_id", "notional_usd", "trade_status"]
    assert got.count() == cold.where("asset_class = 'FX'").count() > 0
