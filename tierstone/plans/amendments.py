"""Amended trades merged into a stored table, partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.functions import row_hash
from tierstone.operators.joins import MONTH_KEYS, TRADE_KEYS, absent_from, newest_versions
from tierstone.schema import COLUMNS, PARTITION_COLUMNS
from tierstone.sources import versions
from tierstone.sources.scans import read_places, with_partition_columns
from tierstone.sources.writer import arrived_meanwhile, laid_out, stage_trades

VERSION = ["trade_id", "_hash"]


def merge_amendments(spark: SparkSession, path: str, changes: DataFrame) -> int:
    """Replace stored trades by newer versions among ``changes``; returns the rows written anew.

    Trades are matched on id and month. Only the months of the changes are read, and only
    partitions with a version that is beaten are rewritten, in one commit; all others keep
    their files. Changes without a stored version are not inserted: that is the promotion's.
    """
    root, table = versions.home(spark, path) or (path, "")
    now = versions.begin(spark, root, {table: len(PARTITION_COLUMNS)})
    named = with_partition_columns(changes).where(F.col("trade_id").isNotNull())
    newest = newest_versions(named)
    # a few months per year of the calendar
    months = {
        f"trade_year={r[0]}/trade_month={r[1]}" for r in newest.select(*MONTH_KEYS).distinct().collect()
    }
    folders = [f for f in now.folders(table) if f.rsplit("/", 1)[0] in months]
    stored = read_places(spark, path, now.of(table, folders))
    known = stored.join(newest.select(*TRADE_KEYS), TRADE_KEYS, "left_semi")
    amended = newest.join(known.select(*TRADE_KEYS), TRADE_KEYS, "left_semi")
    hashed = row_hash(COLUMNS).alias("_hash")
    winners = newest_versions(known.unionByName(amended)).select(*COLUMNS, hashed)
    versions_known = known.select(*COLUMNS, hashed)
    beaten = versions_known.join(winners.select(*VERSION), VERSION, "left_anti")
    # one line per partition that is rewritten
    touched = {
        f"trade_year={r[0]}/trade_month={r[1]}/asset_class={r[2]}"
        for r in beaten.select(*PARTITION_COLUMNS).distinct().collect()
    }
    if not touched:
        return 0
    rewritten = now.of(table, touched)
    rows = read_places(spark, path, rewritten)
    kept = absent_from(rows.select(*COLUMNS, hashed), beaten, VERSION).select(*COLUMNS)
    fresh = absent_from(winners, versions_known, VERSION).select(*COLUMNS)
    staged, written = stage_trades(
        spark, laid_out(kept.unionByName(fresh), PARTITION_COLUMNS), root, table
    )
    read_files = {f.rsplit("/", 1)[-1] for f in rows.inputFiles()}
    late = arrived_meanwhile(spark, root, rewritten, read_files)
    versions.commit(spark, root, rewritten, [*staged, *late])
    return written
