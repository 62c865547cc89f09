"""Promotion: conservation, idempotence, hot keys; stored tiers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierstone.operators import joins, tiers
from tierstone.operators.tiers import promote_tiers, split_tiers
from tierstone.plans import promotion
from tierstone.sources.inventory import read_runs, recent_runs
from tierstone.sources.storage import exists
from tierstone.sources.writer import partition_folders, write_trades
from tierstone.workload.fixtures import AS_OF, stale_tiers


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_promotion_reaches_the_tier_split(trades):
    result = promote_tiers(*stale_tiers(trades), AS_OF)
    for got, want in zip((result.hot, result.warm, result.cold), split_tiers(trades, AS_OF)):
        assert rows(got) == rows(want)


def test_promotion_is_idempotent(recent):
    once = promote_tiers(*stale_tiers(recent), AS_OF)
    twice = promote_tiers(once.hot, once.warm, once.cold, AS_OF)
    assert twice.report().agg(F.sum("rows_promoted")).first()[0] == 0
    assert rows(twice.warm) == rows(once.warm)


def test_rows_without_a_date_stay(recent):
    undated = recent.limit(3).withColumn("trade_date", F.lit(None).cast("date"))
    hot, warm, cold = split_tiers(recent, AS_OF)
    result = promote_tiers(hot.unionByName(undated), warm, cold, AS_OF)
    assert result.hot.where("trade_date is null").count() == 3


def test_absent_from_with_a_hot_key(spark):
    """A third of the batch shares one key."""
    batch = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("same").alias("v"),
    )
    target = spark.range(1500).select(F.col("id").cast("string").alias("k")).unionByName(
        spark.range(1000).select(F.lit("hot").alias("k"))
    )
    got = joins.absent_from(batch, target, ["k"])
    assert rows(got) == rows(batch.join(target, "k", "left_anti"))
    assert got.count() == 1000


def test_absent_from_keeps_null_keys(spark):
    batch = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(joins.absent_from(batch, batch, ["k"])) == ["Row(k=None)"]


def test_rows_without_an_id_are_not_versions_of_each_other(recent):
    nameless = recent.limit(7).withColumn("trade_id", F.lit(None).cast("string"))
    assert joins.newest_versions(recent.unionByName(nameless)).count() == recent.count() + 7
    assert joins.upsert_trades(recent, nameless.unionByName(nameless)).count() == recent.count() + 14


def test_newest_versions_pick_the_last_update(recent):
    ids = [r.trade_id for r in recent.select("trade_id").orderBy("trade_id").limit(5).collect()]
    amended = recent.where(F.col("trade_id").isin(ids)).withColumns(
        {"updated_at": F.lit("2030-01-01").cast("timestamp_ntz"), "trade_status": F.lit("AMENDED")}
    )
    result = joins.upsert_trades(recent, amended)
    assert result.count() == recent.count()
    assert result.where(F.col("updated_at") == "2030-01-01").count() == 5


def test_a_tier_filter_drops_the_other_tiers(trades):
    unified = tiers.unified_trades(*split_tiers(trades, AS_OF))
    plan = unified.where("storage_tier = 'WARM'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.fixture
def stored(spark, recent, folder):
    paths = promotion.TierPaths(folder)
    hot, warm, cold = stale_tiers(recent)
    write_trades(hot, paths.hot, promotion.HOT_KEYS)
    write_trades(warm, paths.warm)
    write_trades(cold, paths.cold)
    return paths


def test_stored_promotion(spark, recent, stored):
    report = {r.tier: r.rows_promoted for r in promotion.promote_stored_tiers(spark, stored, AS_OF).collect()}
    expected = promote_tiers(*stale_tiers(recent), AS_OF).report().collect()
    assert report == {r.tier: r.rows_promoted for r in expected}
    for got, want in zip(promotion.read_tiers(spark, stored), split_tiers(recent, AS_OF)):
        assert rows(got) == rows(want)
    again = promotion.promote_stored_tiers(spark, stored, AS_OF).collect()
    assert [r.rows_promoted for r in again] == [0, 0]
    days = [f.split("=")[1] for f in partition_folders(spark, stored.hot, 1)]
    assert min(days) >= str(AS_OF - dt.timedelta(days=30))
    assert spark.table("v_all_trades").count() == recent.count()
    now = dt.datetime.combine(AS_OF, dt.time(12))
    runs = recent_runs(read_runs(spark, stored.runs), promotion.PROMOTION_JOB, now).collect()
    assert [r.state for r in runs] == ["SUCCEEDED", "SUCCEEDED"]


def test_interrupted_promotion_resumes(spark, recent, stored):
    """Inserts happened, deletes did not: the next run adds nothing twice."""
    from tierstone.sources.writer import append_trades

    hot, warm, cold = promotion.read_tiers(spark, stored)
    append_trades(promote_tiers(hot, warm, cold, AS_OF).to_warm, stored.warm)
    report = promotion.promote_stored_tiers(spark, stored, AS_OF).collect()
    assert report[0].rows_promoted == 0
    for got, want in zip(promotion.read_tiers(spark, stored), split_tiers(recent, AS_OF)):
        assert rows(got) == rows(want)


def test_failed_promotion_is_recorded(spark, recent, stored, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("write operation failed")

    monkeypatch.setattr(promotion, "append_trades", broken)
    with pytest.raises(RuntimeError):
        promotion.promote_stored_tiers(spark, stored, AS_OF)
    assert exists(spark, stored.runs)
    last = read_runs(spark, stored.runs).orderBy(F.desc("completed_time")).first()
    assert (last.state, last.error_message) == ("FAILED", "write operation failed")
