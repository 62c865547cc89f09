"""Each injected defect must flip exactly the checks it breaks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierstone.operators import suite, validation
from tierstone.workload.fixtures import AS_OF, DEFECTS, FIRST_DAY, LAST_DAY, MONTH, YEAR, defective
from tierstone.workload.trades import history

# Failing checks per defect.
MUST_FAIL = {
    "clean": set(),
    "bad_0": {"V2.1", "V3.1", "V4.1", "V4.2", "V5.4"},
    "bad_1": {"V2.1", "V2.2", "V3.1", "V4.1", "V4.2", "V-004"},
    "bad_2": {"V3.3", "V5.4", "C-002"},
    "bad_3": {"V3.1", "V5.4"},
    "bad_4": {"V3.1", "V3.2", "V5.4", "C-001"},
    "bad_5": {"V2.1", "V3.1", "V3.4", "V4.1", "V4.2", "C-003"},
    "bad_6": {"V3.1", "V5.4", "C-004"},
    "bad_7": {"V3.1", "V3.4", "V4.2", "V5.4", "C-003", "C-005"},
    "bad_class": {"V2.1", "V3.1", "V4.1", "V4.2", "V5.4", "V-005"},
}


@pytest.fixture(scope="module")
def trades(spark):
    """Large enough that every defect hits the window; kept in memory."""
    return history(spark, "/root/testdata/sf0.01").trades.where(F.lit(True)).cache()


@pytest.fixture(scope="module")
def legacy(spark):
    return history(spark, "/root/testdata/sf0.01").legacy.where(F.lit(True)).cache()


@pytest.mark.parametrize("name", ["clean", *DEFECTS])
def test_defect_flips_its_checks(trades, legacy, name):
    target = defective(trades, name)
    report = validation.validate_partition(legacy, target, YEAR, MONTH).select("check_id", "result")
    checks = suite.check_table(target, FIRST_DAY, LAST_DAY, AS_OF).select("check_id", "result")
    unique = suite.check_unique(target, FIRST_DAY, LAST_DAY).select("check_id", "result")
    results = dict(map(tuple, report.unionByName(checks).unionByName(unique).collect()))
    assert len(results) == 9 + 10
    assert {check for check, result in results.items() if result != "PASS"} == MUST_FAIL[name]


def test_empty_target_fails_and_two_empty_sides_pass(spark, trades, legacy):
    from tierstone.sources.scans import empty_trades, month_window

    empty = empty_trades(spark)
    report = validation.validate_partition(legacy, empty, YEAR, MONTH).collect()
    results = {row.check_id: row.result for row in report}
    assert results["V2.1"] == results["V3.1"] == results["V4.1"] == "FAIL"
    both = validation.validate_partition(empty, empty, YEAR, MONTH).collect()
    assert {row.result for row in both} == {"PASS"}
    assert validation.notional_sum(empty, empty).first().result == "LEVEL3-1 PASS ✓"
    window = month_window(legacy, YEAR, MONTH)
    assert validation.notional_sum(window, empty).first().result == "LEVEL3-1 FAIL ✗"


def test_days_only_in_target_need_the_outer_profile(trades, legacy):
    from tierstone.sources.scans import month_partition, month_window

    source = month_window(legacy, YEAR, MONTH).where("day(trade_date) > 3")
    target = month_partition(trades, YEAR, MONTH)
    left = {r.result for r in validation.daily_profile(source, target).collect()}
    outer = {r.result for r in validation.daily_profile(source, target, "full_outer").collect()}
    assert left == {"PASS ✓"} and outer == {"PASS ✓", "FAIL ✗"}


def test_sample_check_counts_like_a_join_without_pairing(spark, trades):
    """A heavily repeated id: counts equal those of the plain left join."""
    from tierstone.functions import row_hash

    base = trades.where("trade_year = 1998 and trade_month = 6")
    hot = base.orderBy("trade_id").limit(1)
    copies = hot.crossJoin(spark.range(40)).drop("id")
    changed = hot.crossJoin(spark.range(25)).drop("id").withColumn("direction", F.lit("HOLD"))
    source = base.unionByName(copies).unionByName(changed)
    target = base.unionByName(copies).where("asset_class <> 'FX'")
    sample = base.select("trade_id")
    got = validation.sample_hash_check(source, target, sample).first()
    left = source.select("trade_id", row_hash().alias("h"))
    right = target.select(F.col("trade_id").alias("t"), row_hash().alias("g"))
    want = left.join(right, F.col("trade_id") == F.col("t"), "left").agg(
        F.count(F.lit(1)), F.count_if(F.col("h") == F.col("g")),
        F.count_if(F.col("h") != F.col("g")), F.count_if(F.col("t").isNull()),
    ).first()
    assert tuple(got)[:4] == tuple(want)


def test_suite_runs_every_check_and_reports(spark, trades, folder):
    from tierstone.operators.tiers import split_tiers, unified_trades
    from tierstone.plans.migration import log_rows

    months = trades.groupBy("trade_year", "trade_month").agg(F.count(F.lit(1)).alias("rows_migrated"))
    done, notes = F.lit("COMPLETED").alias("status"), F.lit(None).cast("string").alias("notes")
    log = log_rows(months.select("*", done, notes))
    found = {"trades_cold": True, "trades_warm": True, "v_all_trades": False}
    checks = suite.validate_migration(
        trades, unified_trades(*split_tiers(trades, AS_OF)), log,
        FIRST_DAY, LAST_DAY, AS_OF, found,
    )
    summary = suite.suite_summary(checks).first()
    assert (summary.total_checks, summary.passed, summary.failed, summary.result) == (18, 17, 1, "FAIL")
    early = suite.validate_migration(
        trades, unified_trades(*split_tiers(trades, AS_OF)), log,
        FIRST_DAY, LAST_DAY, AS_OF, found, fail_fast=True,
    )
    assert [r["check_id"] for r in early.collect()] == ["S-001", "S-002", "S-003", "S-004"]
    suite.write_report(checks, f"{folder}/report")
    assert spark.read.json(f"{folder}/report").count() == 18


def test_log_and_pruning_checks_can_fail(spark, trades):
    from tierstone.plans.migration import log_rows

    schema = "trade_year int, trade_month int, rows_migrated long, status string, notes string"
    twice = log_rows(spark.createDataFrame(
        [(1995, 1, 5, "COMPLETED", None), (1995, 1, 5, "COMPLETED", None), (1995, 2, 5, "FAILED", "x")], schema
    ))
    end = FIRST_DAY.replace(month=2, day=28)
    assert suite.check_log_complete(twice, FIRST_DAY, end).first()["result"] == "FAIL"
    assert suite.check_log_failed(twice, FIRST_DAY).first()["result"] == "FAIL"
    assert suite.check_pruned(trades.where("asset_class <> 'FX'"), FIRST_DAY).first()["result"] == "FAIL"
    empty = trades.where("false")
    found = suite.check_table(empty, FIRST_DAY, LAST_DAY, AS_OF)
    failing = {r["check_id"] for r in found.collect() if r["result"] == "FAIL"}
    assert {"V-001", "V-002"} <= failing
