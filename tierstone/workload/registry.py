"""One entry per query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.functions.dates import calendar_months_between, shift_months
from tierstone.functions.hashing import row_hash
from tierstone.operators import joins, suite, tiers, validation
from tierstone.plans import analytics, compaction, migration, promotion, reports, snapshots
from tierstone.schema import PARTITION_COLUMNS
from tierstone.sources import inventory, scans
from tierstone.sources.storage import exists, fresh_path
from tierstone.sources.writer import copy_trades, spread_places, standing_places, write_trades
from tierstone.streaming import ingest
from tierstone.workload.fixtures import (
    AS_OF,
    ASSET_CLASS,
    COUNTERPARTY,
    FAILING_YEAR,
    FIRST_DAY,
    FIRST_YEAR,
    LAST_DAY,
    LAST_YEAR,
    MONTH,
    TRADE_DATE,
    TRADE_ID,
    YEAR,
    defective,
    stale_tiers,
)
from tierstone.workload.oracle import PREDICATES, STRATEGIES, SUITE_KEYS
from tierstone.workload.trades import TradeHistory, history

Query = Callable[[SparkSession, str], DataFrame]

MONTH_START = dt.date(YEAR, MONTH, 1)
MONTH_END = dt.date(YEAR, MONTH, 30)


def _on(query: Callable[[TradeHistory], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(history(spark, sf_dir))


def _split(h: TradeHistory) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tiers.split_tiers(h.trades, AS_OF)


def _promotion(h: TradeHistory) -> tiers.Promotion:
    return tiers.promote_tiers(*stale_tiers(h.trades), AS_OF)


def _unified(h: TradeHistory) -> DataFrame:
    return tiers.unified_trades(*_split(h))


def _per_target(
    labels: list[str], check: Callable[[DataFrame, DataFrame], DataFrame], window: bool = True
) -> Query:
    """``check(source, target)`` against several targets, tagged by name."""

    def query(h: TradeHistory) -> DataFrame:
        results = []
        for label in labels:
            source, target = h.legacy, defective(h.trades, label)
            if window:
                source = scans.month_window(source, YEAR, MONTH)
                target = scans.month_partition(target, YEAR, MONTH)
            result = check(source, target)
            results.append(result.select(F.lit(label).alias("target"), *result.columns))
        return reduce(DataFrame.unionByName, results)

    return _on(query)


def _target_only(labels: list[str], check: Callable[[DataFrame], DataFrame], window: bool = True) -> Query:
    return _per_target(labels, lambda _, target: check(target), window)


def _sample_check(source: DataFrame, target: DataFrame) -> DataFrame:
    sample = validation.sample_ids(scans.month_window(source, YEAR, MONTH))
    return validation.sample_hash_check(source, target, sample)


def _suite_check(check_id: str, labels: list[str]) -> Query:
    if check_id == "V-004":
        return _target_only(
            labels, lambda t: suite.check_unique(t, FIRST_DAY, LAST_DAY), window=False
        )
    return _target_only(
        labels,
        lambda t: suite.check_table(t, FIRST_DAY, LAST_DAY, AS_OF, only=[check_id]),
        window=False,
    )


def _once(label: str) -> Callable[[Callable], Callable]:
    """A stored job that several queries look at runs once for each history, and again when
    its folder is gone; ``anew`` runs it in any case."""

    def keep(job: Callable[[TradeHistory, str], object]):
        done: dict[tuple[str, str], tuple[str, object]] = {}

        def anew(h: TradeHistory):
            root = fresh_path(h.spark, label)
            done[h.spark.sparkContext.applicationId, h.root] = root, job(h, root)
            return done[h.spark.sparkContext.applicationId, h.root][1]

        def run(h: TradeHistory):
            root, result = done.get((h.spark.sparkContext.applicationId, h.root), (None, None))
            return result if root and exists(h.spark, root) else anew(h)

        run.anew = anew
        return run

    return keep


@_once("migrate-range")
def _migration(h: TradeHistory, root: str) -> migration.MigrationPaths:
    """The whole history migrated, snapshot first."""
    paths = migration.MigrationPaths(root)
    migration.migrate_range(h.spark, h.legacy, paths, FIRST_DAY, LAST_DAY)
    return paths


@_once("migrate-failing")
def _failing_migration(h: TradeHistory, root: str) -> migration.MigrationPaths:
    """A migration that stops in the year whose source has rows without an id."""
    paths = migration.MigrationPaths(root)
    bad = (F.year("trade_date") == FAILING_YEAR) & F.col("trade_id").startswith("2")
    source = h.legacy.withColumn("trade_id", F.when(~bad, F.col("trade_id")))
    migration.migrate_range(h.spark, source, paths, FIRST_DAY, LAST_DAY, compact_years=False)
    return paths


def _log(h: TradeHistory) -> DataFrame:
    return migration.read_log(h.spark, _migration(h).log)


def _failing_log(h: TradeHistory) -> DataFrame:
    return migration.read_log(h.spark, _failing_migration(h).log)


def _log_check(check: Callable[[DataFrame], DataFrame]) -> Query:
    def query(h: TradeHistory) -> DataFrame:
        clean, failed = check(_log(h)), check(_failing_log(h))
        return clean.withColumn("target", F.lit("clean")).unionByName(
            failed.withColumn("target", F.lit("failed"))
        )

    return _on(query)


def _views(h: TradeHistory) -> dict[str, bool]:
    hot, warm, cold = _split(h)
    hot.createOrReplaceTempView("trades_hot")
    warm.createOrReplaceTempView("trades_warm")
    cold.createOrReplaceTempView("trades_cold")
    h.legacy.createOrReplaceTempView("trades_cold_legacy")
    tiers.unified_trades(hot, warm, cold).createOrReplaceTempView("v_all_trades")
    names = ["trades_cold", "trades_warm", "v_all_trades"]
    return {name: h.spark.catalog.tableExists(name) for name in names}


def _catalog(h: TradeHistory) -> DataFrame:
    _views(h)
    names = ["trades_hot", "trades_warm", "trades_cold", "v_all_trades", "trades_cold_legacy"]
    return inventory.catalog_tables(h.spark, [*names, "trades_archive"])


def _suite(h: TradeHistory) -> DataFrame:
    log = _log(h)  # reads the flat table, from which the other is then copied
    return suite.validate_migration(
        h.trades, _unified(h), log, FIRST_DAY, LAST_DAY, AS_OF, _views(h)
    )


def _drifted(h: TradeHistory) -> DataFrame:
    target = defective(h.trades, "bad_4").drop("updated_at")
    return target.withColumn("price", F.col("price").cast("double"))


def _months(h: TradeHistory) -> DataFrame:
    return h.trades.select(F.trunc("trade_date", "month").alias("month")).distinct()


def _registry(h: TradeHistory) -> DataFrame:
    """Objects a retention run looks at: a snapshot and a metadata entry per month."""
    month = F.col("month")
    yyyymm = F.date_format(month, "yyyyMM")
    return _months(h).select(
        F.inline(
            F.array(
                F.struct(
                    F.concat(F.lit(snapshots.PREFIX), yyyymm).alias("name"),
                    F.lit("SNAPSHOT").alias("kind"),
                    F.add_months(month, 1).alias("created"),
                ),
                F.struct(
                    F.concat(F.lit("METADATA_"), yyyymm).alias("name"),
                    F.lit("METADATA").alias("kind"),
                    F.last_day(month).alias("created"),
                ),
            )
        )
    )


def _point_in_time(h: TradeHistory) -> DataFrame:
    root = f"{h.root}/snapshots"
    _, _, cold = _split(h)
    snapshots.monthly_snapshot(h.spark, cold, root, AS_OF)
    table = snapshots.as_of_month(h.spark, root, f"{shift_months(AS_OF, -1):%Y%m}")
    return snapshots.point_in_time(table, dt.date(YEAR, 1, 1), dt.date(YEAR, 12, 31), ASSET_CLASS)


@_once("promote")
def _promoted(h: TradeHistory, root: str) -> promotion.TierPaths:
    """Two daily promotions of stored tiers, the second of which is up to date."""
    paths = promotion.TierPaths(root)
    hot, warm, cold = stale_tiers(h.trades)
    write_trades(hot, paths.hot, promotion.HOT_KEYS)
    write_trades(warm, paths.warm)
    copy_trades(cold, paths.cold, sort=True)  # read from partitions, so it needs no shuffle
    for as_of in (AS_OF - dt.timedelta(days=1), AS_OF):
        promotion.promote_stored_tiers(h.spark, paths, as_of)
    return paths


def _job_runs(h: TradeHistory) -> DataFrame:
    runs = inventory.read_runs(h.spark, _promoted(h).runs)
    noon = dt.datetime.combine(AS_OF, dt.time(12))
    recent = inventory.recent_runs(runs, promotion.PROMOTION_JOB, noon, days=7, limit=5)
    return recent.select("name", "state", "scheduled_time", "error_message")


def _month_plan(h: TradeHistory) -> DataFrame:
    return migration.month_plan(h.legacy, _failing_log(h), FIRST_DAY, LAST_DAY)


def _migration_log(h: TradeHistory) -> DataFrame:
    return _log(h).select(
        "source_table", "target_table", "partition_start", "partition_end", "rows_migrated", "status"
    )


def _migrate_month(h: TradeHistory) -> DataFrame:
    paths = migration.MigrationPaths(fresh_path(h.spark, "migrate-month"))
    migration.migrate_months(h.spark, h.legacy, paths, [MONTH_START])
    return migration.migrated(h.spark, paths)


def _migrate_range(h: TradeHistory) -> DataFrame:
    return migration.migrated(h.spark, _migration.anew(h))


def _compact(h: TradeHistory) -> DataFrame:
    """The whole table in small files, two or more per partition, then compacted."""
    path = fresh_path(h.spark, "compact")
    places = standing_places(h.spark, h.trades_path, len(PARTITION_COLUMNS))
    fragments = spread_places(h.spark, h.trades_path, places, 64 * compaction.MB, at_least=2)
    copy_trades(fragments.dropna(subset=PARTITION_COLUMNS), path)
    compaction.compact(h.spark, path, list(range(FIRST_DAY.year, LAST_DAY.year + 1)))
    return scans.read_trades(h.spark, path)


def _promote_stored(h: TradeHistory) -> DataFrame:
    return tiers.unified_trades(*promotion.read_tiers(h.spark, _promoted.anew(h)))


def _later(trades: DataFrame) -> DataFrame:
    """What arrives after the history: amended, moved, repeated and nameless trades."""

    def those(digit: str) -> DataFrame:
        return trades.where(F.col("trade_id").startswith(digit))

    def updated(df: DataFrame, days: int) -> DataFrame:
        return df.withColumn("updated_at", F.col("trade_timestamp") + F.expr(f"INTERVAL {days} DAY"))

    amended = updated(those("3"), 40).withColumn("trade_status", F.lit("AMENDED"))
    moved = updated(those("4"), 41).withColumn("trade_date", F.date_add("trade_date", 45))
    nameless = those("6").withColumn("trade_id", F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, [amended, moved, those("5"), nameless])


def _stream_ingest(h: TradeHistory) -> DataFrame:
    """The history, then what arrives later, then the same again from the start."""
    root = fresh_path(h.spark, "ingest")
    _later(h.legacy).write.option("compression", "zstd").parquet(f"{root}/later")
    for number, feed in enumerate([h.legacy_path, f"{root}/later", f"{root}/later"]):
        stream = ingest.trade_stream(h.spark, feed)
        ingest.ingest(stream, f"{root}/hot", f"{root}/checkpoint-{number}").awaitTermination()
    return scans.with_partition_columns(scans.read_trades(h.spark, f"{root}/hot"))


def _stream_late(h: TradeHistory) -> DataFrame:
    root = fresh_path(h.spark, "late")
    paths = promotion.TierPaths(root)
    feed = ingest.trade_stream(h.spark, h.legacy_path)
    ingest.route_late(feed, paths, f"{root}/late", f"{root}/checkpoint", AS_OF).awaitTermination()
    stored = tiers.unified_trades(*promotion.read_tiers(h.spark, paths))
    late = scans.read_trades(h.spark, f"{root}/late").withColumn("storage_tier", F.lit("LATE"))
    return stored.unionByName(late).select("trade_id", "trade_date", "storage_tier")


def _stream_profile(h: TradeHistory) -> DataFrame:
    root = fresh_path(h.spark, "profile")
    profile = ingest.daily_profile(ingest.trade_stream(h.spark, h.legacy_path))
    ingest.write_profile(profile, f"{root}/days", f"{root}/checkpoint").awaitTermination()
    return ingest.read_profile(h.spark, f"{root}/days")


def _pruning(h: TradeHistory) -> DataFrame:
    predicates = {name: F.expr(text) for name, text in PREDICATES.items()}
    return reports.pruning_report(inventory.file_inventory(h.spark, h.trades_path), predicates)


def _pruning_timed(h: TradeHistory) -> DataFrame:
    timed = {
        "year_class": analytics.year_class_report(h.trades, YEAR, ASSET_CLASS),
        "book_month": analytics.book_month_report(h.trades, YEAR, MONTH),
        "cross_year": analytics.cross_year_report(h.trades, FIRST_YEAR, LAST_YEAR),
        "point_lookup": analytics.point_lookup(h.trades, TRADE_ID),
    }
    rows = [(name, reports.elapsed_seconds(df)) for name, df in timed.items()]
    elapsed = h.spark.createDataFrame(rows, "query string, elapsed_seconds double")
    return _pruning(h).join(elapsed, "query")


def _storage_classes(h: TradeHistory) -> DataFrame:
    files = inventory.file_inventory(h.spark, h.trades_path)
    return reports.storage_class_report({"COLD": files}, AS_OF)


def _analytics() -> dict[str, Query]:
    a = analytics
    return {
        "bench_year_class": _on(lambda h: a.year_class_report(h.trades, YEAR, ASSET_CLASS)),
        "bench_year_class_legacy": _on(
            lambda h: a.year_class_report(h.legacy, YEAR, ASSET_CLASS, by_date=True)
        ),
        "bench_point_lookup": _on(lambda h: a.point_lookup(h.trades, TRADE_ID)),
        "bench_point_lookup_legacy": _on(lambda h: a.point_lookup(h.legacy, TRADE_ID)),
        "bench_point_lookup_pruned": _on(lambda h: a.point_lookup(h.trades, TRADE_ID, TRADE_DATE)),
        "bench_book_month": _on(lambda h: a.book_month_report(h.trades, YEAR, MONTH)),
        "bench_book_month_legacy": _on(
            lambda h: a.book_month_report(h.legacy, YEAR, MONTH, by_date=True)
        ),
        "bench_cross_year": _on(lambda h: a.cross_year_report(h.trades, FIRST_YEAR, LAST_YEAR)),
        "bench_cross_year_legacy": _on(
            lambda h: a.cross_year_report(h.legacy, FIRST_YEAR, LAST_YEAR, by_date=True)
        ),
        "bench_counterparty_latest": _on(lambda h: a.counterparty_latest(h.trades, COUNTERPARTY)),
        "bench_counterparty_latest_legacy": _on(
            lambda h: a.counterparty_latest(h.legacy, COUNTERPARTY)
        ),
    }


def _scans() -> dict[str, Query]:
    next_day = MONTH_END + dt.timedelta(days=1)
    return {
        "scan_tier": _on(lambda h: scans.scan_tier(h.trades)),
        "scan_month_halfopen": _on(lambda h: scans.date_window(h.trades, MONTH_START, next_day)),
        "scan_month_closed": _on(
            lambda h: scans.date_window(h.trades, MONTH_START, MONTH_END, closed=True)
        ),
        "scan_partition": _on(lambda h: scans.month_partition(h.trades, YEAR, MONTH)),
        "materialize_partitions": _on(
            lambda h: h.legacy.select("trade_id", "trade_date", "trade_year", "trade_month")
        ),
        "filter_in_list": _on(
            lambda h: scans.in_list(h.trades, "asset_class", ["FX", "RATES", "CREDIT"])
            .groupBy("asset_class")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum("notional_usd").cast("decimal(32,4)").alias("notional"),
            )
        ),
        "row_hash": _on(lambda h: h.trades.select("trade_id", row_hash().alias("row_hash"))),
        "catalog_tables": _on(_catalog),
        "schema_columns": _on(lambda h: inventory.schema_columns(defective(h.trades, "bad_4"))),
        "schema_diff": _on(lambda h: inventory.schema_diff(h.legacy, _drifted(h))),
        "file_inventory": _on(lambda h: inventory.file_inventory(h.spark, h.trades_path)),
        "job_runs_recent": _on(_job_runs),
    }


def _tiers() -> dict[str, Query]:
    def result(h: TradeHistory) -> DataFrame:
        p = _promotion(h)
        return tiers.unified_trades(p.hot, p.warm, p.cold).select(
            "trade_id", "trade_date", "storage_tier"
        )

    def due(h: TradeHistory) -> DataFrame:
        hot, _, _ = stale_tiers(h.trades)
        return tiers.due_duplicates(defective(hot, "bad_1"), AS_OF)

    def upsert(h: TradeHistory) -> DataFrame:
        amended = h.trades.where(F.col("trade_id").startswith("3")).withColumns(
            {
                "trade_status": F.lit("AMENDED"),
                "updated_at": F.col("trade_timestamp") + F.expr("INTERVAL 40 DAY"),
            }
        )
        return joins.upsert_trades(h.trades, amended)

    return {
        "unified_view": _on(_unified),
        "tier_summary": _on(lambda h: tiers.tier_summary(_unified(h))),
        "promote_to_warm": _on(lambda h: _promotion(h).to_warm),
        "promote_to_cold": _on(lambda h: _promotion(h).to_cold),
        "promote_hot_after": _on(lambda h: _promotion(h).hot),
        "promote_report": _on(lambda h: _promotion(h).report()),
        "promote_result": _on(result),
        "promote_stored_tiers": _on(_promote_stored),
        "hot_due_duplicates": _on(due),
        "late_arrivals": _on(lambda h: joins.late_arrivals(h.trades, defective(h.trades, "bad_0"))),
        "amendments_upsert": _on(upsert),
    }


def _validation() -> dict[str, Query]:
    v = validation
    return {
        "v21_row_count": _per_target(["clean", "bad_0", "bad_1", "bad_5", "bad_class"], v.row_count),
        "v22_duplicate_check": _target_only(["clean", "bad_1"], v.duplicate_check),
        "v23_duplicates": _target_only(["clean", "bad_1"], v.duplicates),
        "v31_notional_sum": _per_target(["clean", "bad_3", "bad_6"], v.notional_sum),
        "v32_null_check": _target_only(["clean", "bad_4"], v.null_check),
        "v33_bad_direction": _target_only(["clean", "bad_2"], v.bad_directions),
        "v34_partition_consistency": _target_only(["clean", "bad_5", "bad_7"], v.partition_consistency),
        "v41_asset_class_dist": _per_target(["clean", "bad_class"], v.asset_class_distribution),
        "v42_daily_profile": _per_target(["clean", "bad_0"], v.daily_profile),
        "v5_sample_ids": _on(lambda h: v.sample_ids(scans.month_window(h.legacy, YEAR, MONTH))),
        "v5_sample_hash": _per_target(["clean", "bad_0", "bad_1", "bad_3"], _sample_check, window=False),
        "d3_class_profile": _on(
            lambda h: v.class_profile(
                scans.month_window(h.legacy, YEAR, MONTH), scans.month_partition(h.trades, YEAR, MONTH)
            )
        ),
        "validation_report": _per_target(
            ["clean", "bad_3"], lambda s, t: v.validate_partition(s, t, YEAR, MONTH), window=False
        ),
        "validate_all_partitions": _per_target(
            ["clean", "bad_5"], v.validate_all_partitions, window=False
        ),
        "signoff": _on(lambda h: v.sign_off(YEAR, MONTH, scans.month_partition(h.trades, YEAR, MONTH))),
    }


def _suite_queries() -> dict[str, Query]:
    # The defect each suite check must catch.
    caught = {
        "V-001": ["bad_empty"], "V-002": ["bad_year"], "V-003": ["bad_id"], "V-004": ["bad_1"], "V-005": ["bad_class"],
        "C-001": ["bad_4"], "C-002": ["bad_2"], "C-003": ["bad_5", "bad_7"],
        "C-004": ["bad_6"], "C-005": ["bad_7"],
    }
    checks = {key: _suite_check(check, ["clean", *caught[check]]) for check, key in SUITE_KEYS.items()}
    return {
        **checks,
        "l001_log_complete": _log_check(lambda log: suite.check_log_complete(log, FIRST_DAY, LAST_DAY)),
        "l002_log_failed": _log_check(lambda log: suite.check_log_failed(log, FIRST_DAY)),
        "q001_view_rows": _on(lambda h: suite.check_view(_unified(h), FIRST_DAY)),
        "q002_pruned": _on(lambda h: suite.check_pruned(h.trades, FIRST_DAY)),
        "validation_suite": _on(_suite),
        "suite_summary": _target_only(
            ["clean", "bad_2", "bad_id"],
            lambda t: suite.suite_summary(
                suite.check_table(t, FIRST_DAY, LAST_DAY, AS_OF).unionByName(
                    suite.check_unique(t, FIRST_DAY, LAST_DAY)
                )
            ),
            window=False,
        ),
        "preflight_source": _on(lambda h: suite.preflight_source(h.legacy)),
        "preflight_duplicates": _target_only(
            ["clean", "bad_1"], suite.preflight_duplicates, window=False
        ),
    }


def _jobs() -> dict[str, Query]:
    def months_to_migrate(h: TradeHistory) -> DataFrame:
        span = h.legacy.groupBy("asset_class").agg(
            F.min("trade_date").alias("earliest_date"), F.max("trade_date").alias("latest_date")
        )
        months = calendar_months_between(F.col("earliest_date"), F.col("latest_date")) + 1
        return span.withColumn("months_to_migrate", months)

    return {
        "fn_months_to_migrate": _on(months_to_migrate),
        "fn_snapshot_names": _on(
            lambda h: _months(h).select(
                F.col("month").alias("run_date"), *snapshots.snapshot_names(F.col("month"))
            )
        ),
        "snapshot_retention": _on(lambda h: snapshots.retention(_registry(h), AS_OF)),
        "point_in_time": _on(_point_in_time),
        "month_plan": _on(_month_plan),
        "migrate_month": _on(_migrate_month),
        "migrate_range": _on(_migrate_range),
        "migration_log": _on(_migration_log),
        "compact_year": _on(_compact),
        "pruning_report": _on(
            lambda h: _pruning(h).select(
                "query", "partitions_scanned", "partitions_total", "pct_partitions_pruned"
            )
        ),
        "pruning_timed": _on(_pruning_timed),
        "partition_advice": _on(lambda h: reports.partition_advice(h.trades, STRATEGIES)),
        "storage_report": _on(
            lambda h: reports.storage_report(
                h.spark, {"trades_cold_legacy": h.legacy_path, "trades_cold": h.trades_path}
            )
        ),
        "partition_storage": _on(lambda h: reports.partition_storage(h.spark, h.trades_path)),
        "storage_class_report": _on(
            lambda h: _storage_classes(h).select("tier", "storage_class", "partitions")
        ),
        "storage_class_cost": _on(_storage_classes),
        "stream_ingest": _on(_stream_ingest),
        "stream_late_routing": _on(_stream_late),
        "stream_daily_profile": _on(_stream_profile),
    }


def queries() -> dict[str, Query]:
    return {
        **_analytics(),
        **_scans(),
        **_tiers(),
        **_validation(),
        **_suite_queries(),
        **_jobs(),
    }
