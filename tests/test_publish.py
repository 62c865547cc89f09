"""Tier moves and partition replacement lose and double nothing, wherever they stop."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tierstone.operators.tiers import split_tiers
from tierstone.plans import promotion
from tierstone.schema import COLUMNS, PARTITION_COLUMNS
from tierstone.sources import inventory, versions, writer
from tierstone.sources.scans import read_trades
from tierstone.sources.storage import list_names
from tierstone.sources.writer import (
    append_trades,
    content_checksum,
    drop_partitions,
    replace_partitions,
    write_trades,
)
from tierstone.workload.fixtures import AS_OF, stale_tiers


@pytest.fixture
def paths(spark, recent, folder):
    paths = promotion.TierPaths(f"{folder}/lake")
    hot, warm, cold = stale_tiers(recent)
    write_trades(hot, paths.hot, promotion.HOT_KEYS)
    write_trades(warm, paths.warm)
    write_trades(cold, paths.cold)
    return paths


def everything(spark, paths):
    hot, warm, cold = promotion.read_tiers(spark, paths)
    return hot.unionByName(warm).unionByName(cold)


@pytest.mark.parametrize("plain", [True, False])
def test_rows_that_arrive_during_a_promotion_are_kept(spark, recent, paths, monkeypatch, plain):
    late = recent.where("trade_date < '2001-08-20'").limit(9)
    if plain:  # their days and months are there already, in hot and in warm
        both = read_trades(spark, paths.warm).select("trade_id")
        late = read_trades(spark, paths.hot).join(both, "trade_id", "left_semi").select(*COLUMNS)
    late = late.withColumn("trade_id", F.concat(F.lit("late"), F.col("trade_id")))
    late = spark.createDataFrame(late.collect(), late.schema)
    assert late.count()
    if not plain:
        promotion.open_tiers(spark, paths)
    stage, calls = promotion.stage_trades, []

    def stage_while_others_write(*args):
        found = stage(*args)
        calls.append(args)
        if len(calls) == 2:  # everything is copied, nothing is committed yet
            for path, keys in ((paths.hot, promotion.HOT_KEYS), (paths.warm, PARTITION_COLUMNS)):
                if plain:  # by a job that began before the table had versions
                    writer._save(late.select(*COLUMNS), path, "append", keys)
                else:
                    append_trades(late, path, keys)
        return found

    monkeypatch.setattr(promotion, "stage_trades", stage_while_others_write)
    promotion.promote_stored_tiers(spark, paths, AS_OF)
    found = everything(spark, paths).where("trade_id LIKE 'late%'")
    assert found.count() == 2 * late.count()
    monkeypatch.undo()
    promotion.promote_stored_tiers(spark, paths, AS_OF)
    assert content_checksum(everything(spark, paths)) == content_checksum(recent.unionByName(late))


def test_promotion_moves_each_trade_once(spark, recent, paths):
    promotion.promote_stored_tiers(spark, paths, AS_OF)
    for got, want in zip(promotion.read_tiers(spark, paths), split_tiers(recent, AS_OF)):
        assert content_checksum(got) == content_checksum(want)


def test_a_promotion_is_one_switch(spark, recent, paths, monkeypatch):
    """Before the commit a reader sees the old tiers, though everything is written; a frame
    resolved before still reads the old version afterwards."""
    promotion.open_tiers(spark, paths)
    before = [content_checksum(t) for t in promotion.read_tiers(spark, paths)]
    resolved = promotion.read_tiers(spark, paths)
    commit, seen = versions.commit, []

    def look_and_commit(*args):
        seen.append([content_checksum(t) for t in promotion.read_tiers(spark, paths)])
        return commit(*args)

    monkeypatch.setattr(versions, "commit", look_and_commit)
    promotion.promote_stored_tiers(spark, paths, AS_OF)
    assert seen == [before] == [[content_checksum(t) for t in resolved]]
    for got, want in zip(promotion.read_tiers(spark, paths), split_tiers(recent, AS_OF)):
        assert content_checksum(got) == content_checksum(want)


@pytest.mark.parametrize("amend", [False, True])
def test_an_amended_trade_reaches_the_tier_that_has_it(spark, recent, folder, amend):
    """Due trades of hot that warm holds in an older version, and some that nothing holds."""
    paths = promotion.TierPaths(f"{folder}/lake")
    _, warm, cold = split_tiers(recent, AS_OF)
    known = warm.where("asset_class IN ('FX', 'RATES')").orderBy("trade_id").limit(4)
    newer = known.withColumns(
        {"trade_status": F.lit("AMENDED"), "updated_at": F.lit("2030-01-01").cast("timestamp_ntz")}
    )
    older = warm.where("asset_class = 'REPO'").limit(2).withColumns(
        {"trade_status": F.lit("STALE"), "updated_at": F.lit("1990-01-01").cast("timestamp_ntz")}
    )
    unknown = newer.withColumn("trade_id", F.concat(F.lit("new"), F.col("trade_id")))
    late = newer.unionByName(older).unionByName(unknown)
    write_trades(late, paths.hot, promotion.HOT_KEYS)
    write_trades(warm, paths.warm)
    write_trades(cold, paths.cold)
    before = promotion.open_tiers(spark, paths)
    promotion.promote_stored_tiers(spark, paths, AS_OF, amend=amend)
    got = read_trades(spark, paths.warm)
    ids = [r[0] for r in known.select("trade_id").collect()]
    stays = warm.where(~F.col("trade_id").isin(ids)) if amend else warm
    expected = stays.unionByName(unknown).unionByName(newer if amend else newer.limit(0))
    assert content_checksum(got) == content_checksum(expected)
    after = promotion.open_tiers(spark, paths)
    touched = set(writer.partition_folders(spark, paths.warm, 3)) & {
        f"trade_year={r[0]}/trade_month={r[1]}/asset_class={r[2]}"
        for r in known.select(*PARTITION_COLUMNS).collect()
    }
    for place in before.of(promotion.WARM):
        if "trade_month=8/" in place.folder:  # the month of the cutoff is rewritten anyway
            continue
        assert place in after.places or (amend and place.folder in touched)


def test_a_promotion_that_dies_anywhere_has_changed_nothing(spark, recent, paths, monkeypatch):
    stage, stop_at = promotion.stage_trades, 0
    for stop_at in range(4):
        calls = []

        def dying(call):
            def run(*args):
                calls.append(args)
                if len(calls) > stop_at:
                    raise RuntimeError("stopped")
                return call(*args)

            return run

        with monkeypatch.context() as patch:
            patch.setattr(promotion, "stage_trades", dying(stage))
            patch.setattr(versions, "commit", dying(versions.commit))
            with pytest.raises(RuntimeError):
                promotion.promote_stored_tiers(spark, paths, AS_OF)
        hot, warm, cold = stale_tiers(recent)
        for got, want in zip(promotion.read_tiers(spark, paths), (hot, warm, cold)):
            assert content_checksum(got) == content_checksum(want)
    promotion.promote_stored_tiers(spark, paths, AS_OF)
    for got, want in zip(promotion.read_tiers(spark, paths), split_tiers(recent, AS_OF)):
        assert content_checksum(got) == content_checksum(want)


def test_a_replacement_that_stops_anywhere_has_changed_nothing(spark, recent, folder, monkeypatch):
    """The run dies before its first, second, ... file-system call; the next one succeeds."""
    path = f"{folder}/table"
    rows = recent.where("trade_month >= 10").cache()
    rows.repartition(3).write.partitionBy(*PARTITION_COLUMNS).parquet(path)
    folders = writer.partition_folders(spark, path, len(PARTITION_COLUMNS))
    wanted = rows.where("asset_class <> 'FX'")
    names = ["_put", "files_of", "run_places", "commit", "load"]
    stop_at, stopped = 0, True
    while stopped:
        calls = []

        def dying(call):
            def run(*args):
                calls.append(args)
                if len(calls) > stop_at:
                    raise RuntimeError("stopped")
                return call(*args)

            return run

        with monkeypatch.context() as patch:
            for name in names:
                patch.setattr(versions, name, dying(getattr(versions, name)))
            try:
                table = read_trades(spark, path)
                replace_partitions(spark, table.where("asset_class <> 'FX'").coalesce(1), path, folders)
                stopped = False
            except RuntimeError:
                pass
        found = read_trades(spark, path)
        assert content_checksum(found) == content_checksum(rows if stopped else wanted)
        stop_at += 1
    assert stop_at > 5


def test_jobs_side_by_side_lose_and_double_nothing(spark, recent, folder, monkeypatch):
    """While one replacement runs, another one, an append and a vacuum go on at every step."""
    for step, others in enumerate(["files_of", "stage_trades", "commit"]):
        path = f"{folder}/table-{step}"
        recent.repartition(2).write.partitionBy(*PARTITION_COLUMNS).parquet(path)
        versions.begin(spark, path, {"": len(PARTITION_COLUMNS)})
        extra = recent.limit(5).withColumn("trade_id", F.concat(F.lit("x"), F.col("trade_id"))).cache()
        extra.count()
        september = [f for f in writer.partition_folders(spark, path, 3) if "month=9/" in f]
        october = [f for f in writer.partition_folders(spark, path, 3) if "month=10/" in f]
        owner = writer if others == "stage_trades" else versions
        call, busy = getattr(owner, others), []

        def beside(*args):
            if not busy:
                busy.append(True)
                later = read_trades(spark, path, folders=october)
                replace_partitions(spark, later.where("asset_class <> 'FX'"), path, october)
                append_trades(extra, path)
                versions.vacuum(spark, path)
            return call(*args)

        with monkeypatch.context() as patch:
            patch.setattr(owner, others, beside)
            mine = read_trades(spark, path, folders=september)
            replace_partitions(spark, mine.where("asset_class <> 'RATES'"), path, september)
        expected = recent.where(
            "NOT (trade_month = 9 AND asset_class = 'RATES') AND NOT (trade_month = 10 AND asset_class = 'FX')"
        ).unionByName(extra)
        assert content_checksum(read_trades(spark, path)) == content_checksum(expected), others


def test_the_second_of_two_jobs_on_the_same_rows_is_refused(spark, recent, folder, monkeypatch):
    path = f"{folder}/table"
    recent.write.partitionBy(*PARTITION_COLUMNS).parquet(path)
    folders = writer.partition_folders(spark, path, 3)
    commit, busy = versions.commit, []

    def beside(*args):
        if not busy:
            busy.append(True)
            replace_partitions(spark, read_trades(spark, path).where("asset_class <> 'FX'"), path, folders)
        return commit(*args)

    monkeypatch.setattr(versions, "commit", beside)
    with pytest.raises(versions.Conflict):
        mine = read_trades(spark, path).where("asset_class <> 'RATES'")
        replace_partitions(spark, mine, path, folders)
    found = read_trades(spark, path)
    assert content_checksum(found) == content_checksum(recent.where("asset_class <> 'FX'"))


def test_a_replacement_must_have_read_something(spark, recent, folder):
    path = f"{folder}/table"
    recent.limit(20).write.partitionBy(*PARTITION_COLUMNS).parquet(path)
    folders = writer.partition_folders(spark, path, 3)
    with pytest.raises(ValueError):  # the plan is empty, so it names no files
        replace_partitions(spark, read_trades(spark, path).where("false"), path, folders)
    assert read_trades(spark, path).count() == 20


def test_one_of_many_gets_a_number(spark, recent, folder):
    path = f"{folder}/table"
    recent.limit(20).write.partitionBy(*PARTITION_COLUMNS).parquet(path)
    versions.begin(spark, path, {"": 3})
    with ThreadPoolExecutor(8) as pool:
        added = [versions.Place("", "f=1", f".run=x/f={k}") for k in range(24)]
        done = list(pool.map(lambda p: versions.commit(spark, path, [], [p]).number, added))
    assert sorted(done) == list(range(2, 26))
    assert set(added) <= versions.load(spark, path).places


def test_vacuum_deletes_what_no_version_names(spark, recent, folder):
    path = f"{folder}/table"
    recent.write.partitionBy(*PARTITION_COLUMNS).parquet(path)
    folders = writer.partition_folders(spark, path, 3)
    for _ in range(3):
        replace_partitions(spark, read_trades(spark, path).coalesce(1), path, folders)
    stored = inventory.file_inventory(spark, path).agg(F.sum("files")).first()[0]
    assert versions.vacuum(spark, path) == 0  # nothing is old enough
    assert versions.vacuum(spark, path, grace_hours=-1) > 0
    assert len([n for n in list_names(spark, path) if n.startswith(versions.RUN)]) == 1
    assert list_names(spark, f"{path}/{versions.VERSIONS}") == [f"{4:012d}.json"]
    assert not versions.plain_folders(spark, path, 3)
    assert content_checksum(read_trades(spark, path)) == content_checksum(recent)
    assert inventory.file_inventory(spark, path).agg(F.sum("files")).first()[0] == stored


def test_a_lake_takes_tables_with_versions_of_their_own(spark, recent, paths):
    days = writer.partition_folders(spark, paths.hot, 1)
    replace_partitions(
        spark, read_trades(spark, paths.hot).coalesce(1), paths.hot, days, keys=promotion.HOT_KEYS
    )
    before = content_checksum(everything(spark, paths))
    promotion.open_tiers(spark, paths)
    assert versions.home(spark, paths.hot) == (paths.root, promotion.HOT)
    assert content_checksum(everything(spark, paths)) == before
    append_trades(recent.limit(7), paths.warm)
    drop_partitions(spark, paths.cold, ["trade_year=1998"])
    assert read_trades(spark, paths.cold).where("trade_year = 1998").count() == 0
