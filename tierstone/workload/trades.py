"""Deriving the trade history from the given order tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.schema import (
    ASSET_CLASSES,
    COLUMNS,
    LEGACY_COLUMNS,
    PARTITION_COLUMNS,
    TRADE_SCHEMA,
)
from tierstone.sources.scans import read_legacy, read_trades
from tierstone.sources.storage import build_once, exists, fingerprint, stored_bytes, workspace
from tierstone.sources.writer import (
    copy_trades,
    enough_shuffle_partitions,
    settings,
    write_by_key,
    write_by_month,
)

SOURCE_TABLES = ["lineitem", "orders", "customer", "nation", "part"]

# Fixed values of the derivation.
CURRENCIES = ["USD", "EUR", "GBP", "JPY"]
SOURCE_SYSTEMS = ["MUREX", "CALYPSO", "SUMMIT"]
TERM_CLASSES = ["RATES", "CREDIT", "DERIVATIVE"]
MIFID_REGION = 3

# Places of the flags in their number.
BOUGHT, CANCELLED, UPDATED, MIFID, STATUS = range(5)

# Part of the stored tables' folder name: raise it when the derivation or the
# layout changes, so that no older copy is picked up.
LAYOUT = "v6"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _digit(flag: Column, place: int) -> Column:
    """A flag that may be NULL as two bits of a number: 0 NULL, 1 false, 2 true."""
    return F.shiftleft(F.coalesce(flag.cast("int") + 1, F.lit(0)), 2 * place)


def _flag(place: int) -> Column:
    bits = F.shiftright("flags", 2 * place).bitwiseAND(3)
    return F.when(bits > 0, bits == 2)


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One narrow row per line item, with its ``trade_date``.

    The order-side tables join each other first, on narrow columns, and the part's texts come
    last. All flags cross the shuffles in one small number. No side is broadcast by hint: Spark
    decides from their sizes, and adaptive execution splits a hot order or part.
    """
    lineitem, orders, customer, nation, part = (
        spark.read.parquet(table_path(sf_dir, name)) for name in SOURCE_TABLES
    )
    status = F.col("o_orderstatus")
    parties = (
        orders.select(
            "o_orderkey", "o_custkey",
            F.when(status == "F", 1).when(status == "O", 2).when(status == "P", 3).otherwise(0)
            .alias("status"),
        )
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey", "o_custkey", "c_nationkey",
            (
                _digit(F.col("n_regionkey") == MIFID_REGION, MIFID)
                + F.shiftleft("status", 2 * STATUS)
            ).alias("party_flags"),
        )
    )
    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_shipdate",
        (
            _digit(F.col("l_linestatus") == "O", BOUGHT)
            + _digit(F.col("l_returnflag") == "R", CANCELLED)
            + _digit(F.col("l_returnflag") == "A", UPDATED)
        ).alias("line_flags"),
    )
    return (
        lines.join(parties, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("flags", F.col("line_flags") + F.col("party_flags"))
        .drop("o_orderkey", "line_flags", "party_flags")
        .join(
            part.select("p_partkey", "p_name", "p_brand", "p_type"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
        .drop("p_partkey")
        .withColumn("trade_date", F.col("l_shipdate").cast("date"))
    )


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _asset_class() -> Column:
    return _pick(ASSET_CLASSES, F.col("l_partkey"))


def _counterparty() -> Column:
    return F.concat(F.lit("CP_"), F.lpad(_text("o_custkey"), 6, "0"))


def as_trades(lines: DataFrame) -> DataFrame:
    """Joined lines as trades, without the partition columns, sorted by date and id in each
    task."""
    return _derived(lines, ["trade_date", "trade_id"], LEGACY_COLUMNS)


def partition_cell() -> Column:
    """A number for each partition of the trade table, from joined lines."""
    months = F.year("trade_date") * 12 + F.month("trade_date")
    classes = len(ASSET_CLASSES)
    return months * classes + (F.col("l_partkey") % classes).cast("int")


def as_keyed_trades(lines: DataFrame) -> DataFrame:
    """Joined lines as trades with the partition columns, sorted as the partitioned table."""
    rows = lines.withColumns(
        {
            "trade_year": F.year("trade_date"),
            "trade_month": F.month("trade_date"),
            "asset_class": _asset_class(),
            "counterparty_id": _counterparty(),
        }
    )
    return _derived(rows, [*PARTITION_COLUMNS, "counterparty_id", "trade_id"], COLUMNS)


def _derived(lines: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Trades from narrow lines. The sort comes before most columns are derived, so it holds
    narrow rows."""
    amount = F.col("l_extendedprice").cast("decimal(22,4)")
    day = F.col("trade_date")
    identity = F.md5(
        F.concat_ws(
            "|",
            _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey"),
            amount.cast("string"), day.cast("string"),
        )
    )
    lines = lines.withColumn("trade_id", identity).sortWithinPartitions(*order)
    discounted = F.col("l_extendedprice").cast("decimal(14,2)") * (
        F.lit(1) - F.col("l_discount")
    ).cast("decimal(4,2)")
    traded = F.expr("l_shipdate + CAST(l_orderkey % 86400 AS INT) * INTERVAL '1' SECOND")
    mifid, status = _flag(MIFID), F.shiftright("flags", 2 * STATUS)
    given = {"asset_class": _asset_class(), "counterparty_id": _counterparty()}

    trades = lines.select(
        "trade_id",
        "trade_date",
        *[c for c in PARTITION_COLUMNS if c in lines.columns],
        *[value.alias(c) for c, value in given.items() if c not in lines.columns],
        *[c for c in ["counterparty_id"] if c in lines.columns],
        traded.alias("trade_timestamp"),
        F.concat(F.lit("INS_"), F.lpad(_text("l_partkey"), 8, "0")).alias("instrument_id"),
        F.col("p_name").alias("instrument_name"),
        F.col("p_type").alias("instrument_subtype"),
        amount.alias("notional_usd"),
        discounted.cast("decimal(22,4)").alias("notional_local"),
        _pick(CURRENCIES, F.col("c_nationkey")).alias("local_currency"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(18,8)").alias("price"),
        F.col("l_quantity").cast("decimal(20,4)").alias("quantity"),
        F.when(_flag(BOUGHT), "BUY").otherwise("SELL").alias("direction"),
        F.upper(F.substring(F.md5(_text("o_custkey")), 1, 20)).alias("counterparty_lei"),
        F.concat(F.lit("TR_"), _text("l_suppkey")).alias("trader_id"),
        F.concat(F.lit("BK_"), F.lpad((F.col("l_partkey") % 200).cast("string"), 4, "0")).alias("book_id"),
        F.col("p_brand").alias("desk_id"),
        F.concat(F.lit("ENT_"), _text("c_nationkey")).alias("entity_id"),
        F.when(_flag(CANCELLED), "CANCELLED")
        .when(status == 1, "SETTLED")
        .when(status == 2, "CONFIRMED")
        .when(status == 3, "AMENDED")
        .alias("trade_status"),
        F.date_add(day, 2).alias("settlement_date"),
        F.date_add(day, 1).alias("value_date"),
        mifid.alias("mifid_flag"),
        F.when(~mifid, "EXEMPT")
        .when(status == 3, "PENDING")
        .otherwise("REPORTED")
        .alias("reporting_status"),
        traded.alias("created_at"),
        F.when(_flag(UPDATED), F.expr("l_shipdate + INTERVAL '30' DAY")).alias("updated_at"),
        _pick(SOURCE_SYSTEMS, F.col("l_linenumber")).alias("source_system"),
    )
    term = F.col("asset_class").isin(TERM_CLASSES)
    return trades.withColumns(
        {
            "maturity_date": F.when(term, F.date_add("trade_date", 365)),
            "uti": F.when(F.col("mifid_flag"), F.concat(F.lit("UTI"), F.col("trade_id"))),
        }
    ).select(*[F.col(c).cast(TRADE_SCHEMA[c].dataType).alias(c) for c in columns])


def derive_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade per line item, without the partition columns."""
    return as_trades(joined_lines(spark, sf_dir))


class TradeHistory:
    """The derived history as two stored tables, each built on first use.

    ``legacy`` is the flat pre-migration source, ``trades`` the table
    partitioned by year, month and asset class. Every query afterwards reads Parquet and can
    prune. A query that reads both asks for the flat one first, so that the five-way join runs
    once. The two frames are kept: their files never change, so they are listed only once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.inputs = [table_path(sf_dir, name) for name in SOURCE_TABLES]
        version = f"{LAYOUT}-{fingerprint(spark, self.inputs)}"
        self.root = f"{workspace(spark)}/tierstone-history/{version}"

    def _built(self, name: str, inputs: list[str], write: Callable[[str], None]) -> str:
        partitions = enough_shuffle_partitions(self.spark, stored_bytes(self.spark, inputs))
        with settings(self.spark, shuffle__partitions=partitions):
            return build_once(self.spark, f"{self.root}/{name}", write)

    @cached_property
    def legacy_path(self) -> str:
        return self._built(
            "legacy",
            self.inputs,
            lambda path: write_by_month(joined_lines(self.spark, self.sf_dir), path, as_trades),
        )

    @cached_property
    def trades_path(self) -> str:
        """Copied from the flat table if that is there; else built without it."""
        if "legacy_path" in vars(self) or exists(self.spark, f"{self.root}/legacy/_SUCCESS"):
            return self._built(
                "trades",
                [self.legacy_path],
                lambda path: copy_trades(self.legacy, path, sort=True, id_filter=True),
            )
        return self._built(
            "trades",
            self.inputs,
            lambda path: write_by_key(
                joined_lines(self.spark, self.sf_dir), path, partition_cell(), as_keyed_trades
            ),
        )

    @cached_property
    def legacy(self) -> DataFrame:
        return read_legacy(self.spark, self.legacy_path)

    @cached_property
    def trades(self) -> DataFrame:
        return read_trades(self.spark, self.trades_path)


_histories: dict[tuple[str, str], TradeHistory] = {}


def history(spark: SparkSession, sf_dir: str) -> TradeHistory:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _histories:
        _histories[key] = TradeHistory(spark, sf_dir)
    return _histories[key]
