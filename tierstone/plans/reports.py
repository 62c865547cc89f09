"""Storage, pruning, ageing and partition-design reports."""

from __future__ import annotations

import datetime as dt
import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.schema import PARTITION_COLUMNS
from tierstone.sources.inventory import data_files, file_inventory
from tierstone.sources import versions
from tierstone.sources.storage import list_names

# List prices and limits.
USD_PER_TB = 40
USD_PER_GB = {
    "STANDARD": 0.023,
    "INTELLIGENT_TIERING": 0.023,
    "STANDARD_IA": 0.0125,
    "GLACIER_IR": 0.004,
}
MIN_CARDINALITY, MAX_CARDINALITY, MAX_PARTITIONS = 2, 1000, 50_000
GB, TB = 1024**3, 1024**4


def partition_keys(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a table folder; none for a flat one."""
    found = versions.home(spark, path)
    names = versions.load(spark, found[0]).folders(found[1]) if found else list_names(spark, path)
    keyed = any(name.startswith(f"{PARTITION_COLUMNS[0]}=") for name in names)
    return PARTITION_COLUMNS if keyed else []


def storage_report(spark: SparkSession, paths: dict[str, str], usd_per_tb: float = USD_PER_TB) -> DataFrame:
    """Footprint and monthly cost per table; plain files retain no old versions."""
    tables = [
        data_files(spark, path, keys=partition_keys(spark, path))
        .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("active_bytes"))
        .select(F.lit(name).alias("table_name"), "files", "active_bytes")
        for name, path in paths.items()
    ]
    active = F.col("active_bytes")
    terabyte = F.pow(F.lit(1024), F.lit(4))
    return (
        reduce(DataFrame.unionByName, tables)
        .withColumns({"time_travel_bytes": F.lit(0), "failsafe_bytes": F.lit(0)})
        .select(
            "table_name",
            "files",
            "active_bytes",
            F.round(active / terabyte, 3).alias("active_tb"),
            F.round(F.col("time_travel_bytes") / terabyte, 3).alias("time_travel_tb"),
            F.round(F.col("failsafe_bytes") / terabyte, 3).alias("failsafe_tb"),
            F.round(
                (active + F.col("time_travel_bytes") + F.col("failsafe_bytes")) / terabyte * usd_per_tb, 2
            ).alias("est_monthly_usd"),
        )
        .orderBy(F.desc("est_monthly_usd"), "table_name")
    )


def partition_storage(spark: SparkSession, path: str, usd_per_tb: float = USD_PER_TB) -> DataFrame:
    """The same per partition."""
    return file_inventory(spark, path).withColumn(
        "est_monthly_usd", F.round(F.col("bytes") / TB * usd_per_tb, 6)
    )


def pruned_share(scanned: Column, total: Column) -> Column:
    """Percentage of partitions skipped; NULL for a table without partitions."""
    share = scanned.cast("double") / F.nullif(total, F.lit(0))
    return F.round(F.lit(100) * (F.lit(1) - share), 1)


def pruning_report(inventory: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Partitions and bytes each query's partition predicate leaves to scan.

    ``inventory`` has one row per partition with its ``bytes``.
    """
    measures = []
    for name, predicate in predicates.items():
        measures += [
            F.count_if(predicate).alias(f"{name}__scanned"),
            F.coalesce(F.sum(F.when(predicate, F.col("bytes"))), F.lit(0)).alias(f"{name}__bytes"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("query"),
            F.round(F.col(f"{name}__bytes") / GB, 6).alias("gb_scanned"),
            F.col(f"{name}__scanned").alias("partitions_scanned"),
            F.col("total").alias("partitions_total"),
            pruned_share(F.col(f"{name}__scanned"), F.col("total")).alias("pct_partitions_pruned"),
        )
        for name in predicates
    ]
    return inventory.agg(F.count(F.lit(1)).alias("total"), *measures).select(
        F.inline(F.array(*lines))
    )


def elapsed_seconds(df: DataFrame) -> float:
    """Wall time of running a query to completion without keeping its result."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def partition_advice(df: DataFrame, strategies: dict[str, list[str]]) -> DataFrame:
    """Cardinality and partition count of candidate partition specs, with a verdict.

    One pass reduces the table to the distinct combinations of all candidate
    columns with map-side combining; everything else is counted on those.
    """
    columns = list(dict.fromkeys(c for spec in strategies.values() for c in spec))
    combos = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    counts = [F.count_distinct(c).alias(f"n_{c}") for c in columns]
    specs = [
        F.count_distinct(F.struct(*spec)).alias(f"observed_{i}")
        for i, spec in enumerate(strategies.values())
    ]
    lines = []
    for i, (name, spec) in enumerate(strategies.items()):
        sizes = [F.col(f"n_{c}") for c in spec]
        product = reduce(lambda a, b: a * b, sizes)
        lowest, highest = (F.least(*sizes), F.greatest(*sizes)) if len(sizes) > 1 else (sizes[0],) * 2
        sound = (
            (lowest >= MIN_CARDINALITY) & (highest <= MAX_CARDINALITY) & (product <= MAX_PARTITIONS)
        )
        lines.append(
            F.struct(
                F.lit(name).alias("strategy"),
                lowest.alias("min_cardinality"),
                highest.alias("max_cardinality"),
                product.alias("possible_partitions"),
                F.col(f"observed_{i}").alias("observed_partitions"),
                F.when(sound, "OK").otherwise("REDESIGN").alias("verdict"),
            )
        )
    return combos.agg(*counts, *specs).select(F.inline(F.array(*lines)))


def partition_age(as_of: dt.date) -> Column:
    """Days since the last day of a partition's month."""
    month_end = F.last_day(F.make_date("trade_year", "trade_month", F.lit(1)))
    return F.datediff(F.lit(as_of), month_end)


def storage_class(tier: str, age: Column, warm_days: int = 90, ia_days: int = 30, glacier_days: int = 90) -> Column:
    """The storage class the lifecycle rules put a partition of that age in."""
    if tier == "WARM":
        return F.when(age >= warm_days, "INTELLIGENT_TIERING").otherwise("STANDARD")
    if tier == "COLD":
        return (
            F.when(age >= glacier_days, "GLACIER_IR")
            .when(age >= ia_days, "STANDARD_IA")
            .otherwise("STANDARD")
        )
    return F.lit("STANDARD")


def storage_class_report(inventories: dict[str, DataFrame], as_of: dt.date, **rules: int) -> DataFrame:
    """Partitions, bytes and list-price cost per tier and storage class.

    Each inventory has one row per partition with its ``bytes``.
    """
    classed = [
        inventory.select(
            F.lit(tier).alias("tier"),
            storage_class(tier, partition_age(as_of), **rules).alias("storage_class"),
            "bytes",
        )
        for tier, inventory in inventories.items()
    ]
    price = F.create_map(*[F.lit(x) for pair in USD_PER_GB.items() for x in pair])
    return (
        reduce(DataFrame.unionByName, classed)
        .groupBy("tier", "storage_class")
        .agg(F.count(F.lit(1)).alias("partitions"), F.sum("bytes").alias("bytes"))
        .withColumn("monthly_usd", F.round(F.col("bytes") / GB * price[F.col("storage_class")], 6))
        .orderBy("tier", "storage_class")
    )
