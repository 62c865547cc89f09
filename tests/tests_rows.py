"""Rows that tests of the larger jobs build for themselves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierstone.schema import COLUMNS, TRADE_SCHEMA
from tierstone.sources.scans import with_partition_columns
from tierstone.workload.trades import table_path

LINES = (
    "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
    "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string"
)


def trade_rows(spark, ids, day):
    given = {
        "trade_id": F.col("trade_id"),
        "trade_date": F.lit(day),
        "trade_timestamp": F.lit(dt.datetime.combine(day, dt.time(9))),
        "created_at": F.lit(dt.datetime.combine(day, dt.time(9))),
        "asset_class": F.lit("FX"),
        "notional_usd": F.lit(5),
        "quantity": F.lit(2),
        "direction": F.lit("BUY"),
        "trade_status": F.lit("NEW"),
    }
    rows = spark.createDataFrame([(i,) for i in ids], "trade_id string")
    return with_partition_columns(
        rows.select(*[given.get(c, F.lit(None)).cast(TRADE_SCHEMA[c].dataType).alias(c) for c in COLUMNS])
    )


def order_tables(spark, folder):
    """Two hundred lines, some with NULL flags, copies and keys that lead nowhere."""

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(table_path(folder, name))

    day = dt.datetime(1998, 1, 20)
    lines = [
        (k % 40, k % 7, k % 25, k % 5, 1.0 + k % 3, 5.0 + k, 0.1, day + dt.timedelta(days=k % 90),
         ["R", "A", "N", None][k % 4], ["O", "F", None][k % 3])
        for k in [*range(190), *range(10)]
    ]
    put("lineitem", lines, LINES)
    orders = [(k, k % 9, ["F", "O", "P", None][k % 4]) for k in range(39)]
    put("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string")
    put("customer", [(k, k % 4) for k in range(9)], "c_custkey long, c_nationkey int")
    put("nation", [(k, [3, None, 1, 3][k]) for k in range(4)], "n_nationkey int, n_regionkey int")
    part = [(k, f"name {k}", "b", "t") for k in range(25)]
    put("part", part, "p_partkey long, p_name string, p_brand string, p_type string")
