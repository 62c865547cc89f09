"""What crosses the shuffles of the larger jobs, and that the results stay whole."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tests_rows import order_tables, trade_rows
from tierstone.operators import joins, tiers, validation
from tierstone.plans import compaction, migration
from tierstone.schema import COLUMNS, PARTITION_COLUMNS
from tierstone.plans.promotion import TierPaths, read_tiers
from tierstone.sources import id_index, scans, writer
from tierstone.sources.inventory import data_files, file_inventory
from tierstone.sources.storage import exists
from tierstone.streaming import ingest
from tierstone.workload import trades

DAY = dt.date(1998, 6, 1)


def texts(df):
    return sorted(str(r) for r in df.select(*[F.col(c).cast("string") for c in COLUMNS]).collect())


def test_trades_are_built_without_the_flat_table(spark, folder):
    order_tables(spark, folder)
    direct, copied = trades.TradeHistory(spark, folder), trades.TradeHistory(spark, folder)
    direct.root, copied.root = f"{folder}/direct", f"{folder}/copied"
    assert copied.legacy_path and texts(direct.trades) == texts(copied.trades) != []
    assert exists(spark, f"{copied.root}/legacy") and not exists(spark, f"{direct.root}/legacy")


def test_write_tasks_are_small_beside_three_others(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with writer.writing(spark, writer.NARROW_BYTES):
        narrow = spark.conf.get(name)
    with writer.writing(spark):
        wide = spark.conf.get(name)
    assert (int(narrow.rstrip("m")), int(wide.rstrip("m"))) <= (64, 128)
    assert int(writer.READ_BYTES.rstrip("m")) <= 64


def test_bits_split_a_table_and_lose_no_match(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("trade_id"))
    ids = ids.unionByName(spark.createDataFrame([(None,)], "trade_id string"))
    some = ids.where("trade_id % 10 = 0")
    bits = joins.hash_bits(some, ["trade_id"])
    near, apart = (joins.with_bits(ids, bits, ["trade_id"], h) for h in ("left_semi", "left_anti"))
    assert near.count() + apart.count() == 2001 and near.columns == ["trade_id"]
    assert near.join(some, "trade_id").count() == 200 and apart.join(some, "trade_id").count() == 0
    assert near.count() < 250


def test_wide_rows_that_no_change_touches_do_not_cross_a_shuffle(spark, monkeypatch):
    current = trade_rows(spark, ["a", "a", "b", "c", None], DAY)
    changes = trade_rows(spark, ["b", None], DAY).withColumn("trade_status", F.lit("AMENDED"))
    changes = changes.withColumn("updated_at", F.expr("created_at + INTERVAL 1 DAY"))
    rows = joins.upsert_trades(current, changes).select("trade_id", "trade_status").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("a", "NEW"), ("a", "NEW"), ("b", "AMENDED"), ("c", "NEW"), (None, "NEW"), (None, "AMENDED")],
        key=str,
    )
    plan = joins.upsert_trades(current, changes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or") >= 2  # in both parts of the split


def test_promotion_moves_what_the_target_lacks(spark):
    batch = trade_rows(spark, ["a", "b", "b", None], DAY)
    target = trade_rows(spark, ["a", "x", None], DAY)
    moved = joins.new_trades(batch, target)
    assert sorted(str(r.trade_id) for r in moved.collect()) == ["None", "b", "b"]


def test_month_ids_are_counted_apart_from_the_sums(spark):
    hexes = ["00ff", "00FF", "00ff", "0ff", "", "\x01ff", None, "0001", "01"]
    source = trade_rows(spark, hexes, DAY)
    other = trade_rows(spark, ["k"], DAY).withColumn("trade_year", F.lit(None).cast("int"))
    line = {r.trade_year: r for r in validation.validate_all_partitions(source, source.unionByName(other)).collect()}
    assert (line[1998].target_rows, line[1998].target_ids, line[1998].result) == (9, 7, "FAIL")
    assert (line[None].source_rows, line[None].target_rows, line[None].target_ids) == (0, 1, 1)
    good = trade_rows(spark, ["a", "b"], DAY)
    assert [r.result for r in validation.validate_all_partitions(good, good).collect()] == ["PASS"]
    alone = validation.validate_all_partitions(good, good)
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "unhex" in x and "sum(" in x]
    size = F.length(validation.short_id())
    assert spark.createDataFrame([("0f" * 16,)], "trade_id string").select(size).first()[0] == 17


def test_a_copied_cold_tier_promotes_like_a_written_one(spark, folder):
    cold = trade_rows(spark, ["a", "b", "c"], DAY)
    writer.write_trades(cold, f"{folder}/written")
    writer.copy_trades(scans.read_trades(spark, f"{folder}/written"), f"{folder}/copied", sort=True)
    got = scans.read_trades(spark, f"{folder}/copied")
    assert texts(got) == texts(cold)
    late = trade_rows(spark, ["c", "d"], DAY)
    empty = cold.where("false")
    p = tiers.promote_tiers(late, empty, got, DAY + dt.timedelta(days=200))
    assert [r.rows_promoted for r in p.report().orderBy("tier").collect()] == [2, 1]


def test_the_target_is_written_from_the_snapshot_without_a_shuffle(spark, folder, monkeypatch):
    days = [DAY, DAY + dt.timedelta(days=40), DAY + dt.timedelta(days=70)]
    ids = ["a", "b", "b", "c", None, "d"] * 20
    rows = reduce(DataFrame.unionByName, [trade_rows(spark, ids, day) for day in days])
    rows = rows.withColumn("asset_class", F.when(F.col("trade_id") == "a", "RATES").when(F.col("trade_id") != "b", "A/B"))
    writer.copy_trades(rows.repartition(5), f"{folder}/copy")
    many = data_files(spark, f"{folder}/copy").count()
    gathered = writer.gathered_copy(spark, f"{folder}/copy")
    assert texts(gathered) == texts(rows)
    assert "Exchange" not in gathered._jdf.queryExecution().executedPlan().toString()
    assert writer.append_laid_out(gathered, f"{folder}/target") == rows.count()
    files = data_files(spark, f"{folder}/target").count()
    assert files == rows.select(*PARTITION_COLUMNS).distinct().count() < many
    assert texts(scans.read_trades(spark, f"{folder}/target")) == texts(rows)

    def no_shuffle(rows, path):
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        return writer.append_laid_out(rows, path)

    monkeypatch.setattr(migration, "append_trades", no_shuffle)
    paths = migration.MigrationPaths(f"{folder}/lake")
    good = reduce(DataFrame.unionByName, [trade_rows(spark, ["a", "b"], day) for day in days])
    log = migration.migrate_range(spark, good, paths, DAY, days[-1])
    assert [r.status for r in log.collect()] == ["COMPLETED"] * 3
    assert texts(migration.migrated(spark, paths)) == texts(good)


def test_a_large_folder_of_a_copy_is_read_by_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(writer, "READ_BYTES", "1m")
    size = 3 * 1024 * 1024
    monkeypatch.setattr(writer, "stored_bytes", lambda spark, paths: size)
    rows = trade_rows(spark, [str(k) for k in range(400)], DAY)
    writer.copy_trades(rows.repartition(8), f"{folder}/copy")
    gathered = writer.gathered_copy(spark, f"{folder}/copy")
    assert "Coalesce 3" in gathered._jdf.queryExecution().executedPlan().toString()
    assert texts(gathered) == texts(rows)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def changed(rows, status, hours):
    return rows.withColumns(
        {"trade_status": F.lit(status), "updated_at": F.expr(f"created_at + INTERVAL {hours} HOUR")}
    )


def test_ingest_lays_out_slices_and_leaves_other_rows_in_their_tasks(spark, folder, monkeypatch):
    """repeated ids in a batch, amended, older, moved, nameless and undated trades, replayed."""
    days = [DAY + dt.timedelta(days=k) for k in range(4)]
    ids = [f"k{k}" for k in range(20)]
    first = reduce(DataFrame.unionByName, [trade_rows(spark, [f"{i}-{d.day}" for i in ids], d) for d in days])
    undated = trade_rows(spark, ["u", None], DAY).withColumn("trade_date", F.lit(None).cast("date"))
    first = first.unionByName(undated).unionByName(trade_rows(spark, [None], days[1]))
    some = first.where("trade_id LIKE 'k1-%'")
    later = reduce(
        DataFrame.unionByName,
        [
            changed(some, "NEWER", 2),
            changed(some, "NEWEST", 3),
            changed(first.where("trade_id = 'k2-1'"), "OLDER", -3),
            first.where("trade_id = 'k3-1' OR trade_id IS NULL"),
            changed(first.where("trade_id = 'k4-2'"), "MOVED", 1).withColumn("trade_date", F.lit(days[3])),
            changed(first.where("trade_id = 'u'"), "DATED", 1).withColumn("trade_date", F.lit(DAY)),
            trade_rows(spark, ["new", "new", None, None], days[2]).withColumn("uti", F.lit("x")),
        ],
    )
    first.write.parquet(f"{folder}/first")
    later.write.parquet(f"{folder}/later")
    monkeypatch.setattr(writer, "SLICE_ROWS", 25)
    monkeypatch.setattr(id_index, "SLICE_ENTRIES", 30)
    real, plans = ingest.stage_trades, []

    def staged(spark, rows, *more):
        plans[-1].append("RebalancePartitions" in optimized(rows))
        return real(spark, rows, *more)

    monkeypatch.setattr(ingest, "stage_trades", staged)
    for number, feed in enumerate(["first", "later", "later"]):
        plans.append([])
        stream = ingest.trade_stream(spark, f"{folder}/{feed}")
        ingest.ingest(stream, f"{folder}/hot", f"{folder}/cp-{number}").awaitTermination()
    named = joins.newest_versions(first.unionByName(later).where("trade_id IS NOT NULL"))
    nameless = first.where("trade_id IS NULL").unionByName(later.where("trade_id IS NULL AND uti = 'x'"))
    found = scans.with_partition_columns(scans.read_trades(spark, f"{folder}/hot"))
    assert texts(found) == texts(scans.with_partition_columns(named.unionByName(nameless)))
    assert len(plans[0]) == 4 and all(plans[0])
    assert plans[1].count(False) == 1  # the rest of the rewritten days
    index = ingest.hot_index(spark, f"{folder}/hot")
    now = index.begin(spark)
    assert all(len(now.of("", [d])) <= 2 for d in now.folders(""))
    entries = index.read(spark, now, range(id_index.BUCKETS))
    assert entries.distinct().count() == named.count() + 2  # two moved: their old days stay


def test_only_rows_with_a_repeated_id_are_compared(spark, folder):
    rows = trade_rows(spark, ["a", "b", "b", None, None], DAY)
    with ingest.scratch(spark) as stored:
        once = ingest.collapsed(rows, stored)
        assert sorted(str(r.trade_id) for r in once.collect()) == ["None", "None", "a", "b"]
        alone = ingest.collapsed(trade_rows(spark, ["a", "b", None, None], DAY), stored)
        assert alone.count() == 4 and "Aggregate" not in optimized(alone)


def test_late_trades_are_routed_in_slices(spark, folder, monkeypatch):
    """several months of each tier, repeated, nameless and undated trades, and a replay."""
    as_of = DAY + dt.timedelta(days=30)
    days = [as_of - dt.timedelta(days=k) for k in (1, 25, 45, 80, 100, 140, 400)]
    rows = reduce(DataFrame.unionByName, [trade_rows(spark, ["a", "b", "b", None], d) for d in days])
    rows = rows.withColumn("trade_id", F.concat("trade_id", F.col("trade_date").cast("string")))
    undated = trade_rows(spark, ["u"], DAY).withColumn("trade_date", F.lit(None).cast("date"))
    rows.unionByName(undated).write.parquet(f"{folder}/feed")
    monkeypatch.setattr(writer, "SLICE_ROWS", 3)
    real, appended = writer.append_trades, []

    def append(part, path, keys):
        appended.append(real(part, path, keys))
        return appended[-1]

    monkeypatch.setattr(writer, "append_trades", append)
    paths = TierPaths(f"{folder}/lake")
    for run in range(2):
        feed = ingest.trade_stream(spark, f"{folder}/feed")
        ingest.route_late(feed, paths, f"{folder}/late-{run}", f"{folder}/cp-{run}", as_of).awaitTermination()
    once = joins.newest_versions(rows)
    expected = once.unionByName(once.where("trade_id IS NULL"))  # these match nothing
    for got, want in zip(read_tiers(spark, paths), tiers.split_tiers(expected, as_of)):
        assert texts(got) == texts(want) != []
    _, warm, cold = tiers.split_tiers(once, as_of)
    assert texts(scans.read_trades(spark, f"{folder}/late-0")) == texts(warm.unionByName(cold))
    assert scans.read_trades(spark, f"{folder}/late-1").where("trade_id IS NOT NULL").count() == 0
    assert appended[:7] == [3] * 7


def test_slices_of_a_table_with_versions_are_one_version(spark, folder, monkeypatch):
    monkeypatch.setattr(writer, "SLICE_ROWS", 2)
    rows = reduce(
        DataFrame.unionByName,
        [trade_rows(spark, ["a", "b", None], DAY + dt.timedelta(days=40 * k)) for k in range(3)],
    )
    start = writer.versions.begin(spark, f"{folder}/table", {"": 3})
    assert writer.append_in_slices(rows, f"{folder}/table") == 9
    assert writer.versions.load(spark, f"{folder}/table").number == start.number + 1
    assert texts(scans.read_trades(spark, f"{folder}/table")) == texts(rows)


def test_compaction_moves_no_row_through_a_shuffle(spark, folder, monkeypatch):
    """fragments of two files a partition, merged where they are read."""
    days = [DAY + dt.timedelta(days=40 * k) for k in range(3)]
    rows = reduce(DataFrame.unionByName, [trade_rows(spark, ["a", "b", "b", None, "c"] * 9, d) for d in days])
    writer.write_trades(rows, f"{folder}/table")
    places = writer.standing_places(spark, f"{folder}/table", 3)
    halves = writer.spread_places(spark, f"{folder}/table", places, 1 << 26, at_least=2)
    assert texts(halves) == texts(rows) and "Exchange" not in str(halves._jdf.queryExecution().executedPlan())
    writer.copy_trades(halves, f"{folder}/small")
    assert {r.files for r in file_inventory(spark, f"{folder}/small").collect()} == {2}
    real = compaction.replace_partitions

    def no_shuffle(spark, df, path, folders):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        return real(spark, df, path, folders)

    monkeypatch.setattr(compaction, "replace_partitions", no_shuffle)
    assert compaction.compact(spark, f"{folder}/small", [1998]) == 3
    assert {r.files for r in file_inventory(spark, f"{folder}/small").collect()} == {1}
    assert texts(scans.read_trades(spark, f"{folder}/small")) == texts(rows)
