"""How the history is built: narrow rows cross the shuffles, and tasks stay small."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierstone.schema import LEGACY_COLUMNS
from tierstone.sources import writer
from tierstone.sources.scans import read_legacy, read_trades, with_partition_columns
from tierstone.workload import trades

LINES = (
    "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
    "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string"
)


def tables(spark, folder):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(trades.table_path(folder, name))

    day = dt.datetime(1998, 6, 1)
    put("lineitem", [(1, 1, 1, 7, 2.0, 5.0, 0.1, day, "R", "O"), (1, 2, 2, 7, 2.0, 6.0, 0.0, day, "A", "F"),
                     (2, 1, 1, 7, 2.0, 7.0, 0.0, day + dt.timedelta(days=40), None, None)], LINES)
    put("orders", [(1, 1, "F"), (2, 2, "P"), (2, 2, None)], "o_orderkey long, o_custkey long, o_orderstatus string")
    put("customer", [(1, 1), (2, 2)], "c_custkey long, c_nationkey int")
    put("nation", [(1, 3), (2, None)], "n_nationkey int, n_regionkey int")
    put("part", [(k, f"name {k}", "b", "t") for k in (1, 2)], "p_partkey long, p_name string, p_brand string, p_type string")


def test_flags_and_nulls_become_the_same_texts(spark, folder):
    tables(spark, folder)
    rows = trades.derive_trades(spark, folder).orderBy("notional_usd", "trade_status").collect()
    got = [(r.direction, r.trade_status, r.reporting_status, r.mifid_flag, r.updated_at) for r in rows]
    assert got == [
        ("BUY", "CANCELLED", "REPORTED", True, None),
        ("SELL", "SETTLED", "REPORTED", True, dt.datetime(1998, 7, 1)),
        ("SELL", None, "REPORTED", None, None),
        ("SELL", "AMENDED", "PENDING", None, None),
    ]
    assert list(rows[0].asDict()) == LEGACY_COLUMNS


def test_wide_columns_are_derived_after_the_last_shuffle(spark, folder):
    tables(spark, folder)
    lines = trades.joined_lines(spark, folder)
    assert not {"counterparty_id", "uti", "trade_id", "price"} & set(lines.columns)
    rows = trades.as_trades(lines.hint("rebalance", "trade_date"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert "counterparty_lei" in above and "counterparty_lei" not in below


def test_partitioned_copy_of_a_dated_table_has_no_shuffle(spark, folder):
    tables(spark, folder)
    writer.write_by_month(trades.joined_lines(spark, folder), f"{folder}/flat", trades.as_trades)
    flat = read_legacy(spark, f"{folder}/flat")
    writer.copy_trades(flat, f"{folder}/keyed", sort=True)
    key = [F.col(c).cast("string") for c in flat.columns]
    expected = with_partition_columns(trades.derive_trades(spark, folder)).select(*key).collect()
    assert sorted(map(str, read_trades(spark, f"{folder}/keyed").select(*key).collect())) == sorted(map(str, expected))


def test_shuffle_files_of_a_write_go_with_it(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with writer.writing(spark):
        assert spark.conf.get(name) == "true"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == writer.READ_BYTES


def test_spreading_makes_tasks_of_bounded_size(spark, recent):
    parts = recent.select(*writer.PARTITION_COLUMNS).distinct().withColumn("bytes", F.lit(1 << 30))
    mb = 1024 * 1024
    spread = writer.spread_by_size(recent, parts, 512 * mb)
    assert spread.rdd.getNumPartitions() * writer.TASK_BYTES >= parts.count() << 30
