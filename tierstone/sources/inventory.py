"""Catalog, column, file and job-run listings."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.schema import JOB_RUN_SCHEMA, PARTITION_COLUMNS, TRADE_SCHEMA
from tierstone.sources import versions
from tierstone.sources.scans import place_groups
from tierstone.sources.storage import exists


def catalog_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """Which of ``names`` exist in the session catalog, with type and row count."""
    found = {t.name: t for t in spark.catalog.listTables()}
    listed = []
    for name in names:
        table = found.get(name)
        row = F.lit(name).alias("table_name"), F.lit(table is not None).alias("table_exists")
        if table is None:
            listed.append(
                spark.range(1).select(*row, F.lit(None).cast("bigint").alias("row_count"))
            )
        else:
            counted = spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
            listed.append(counted.select(*row, "row_count"))
    return reduce(DataFrame.unionByName, listed)


def schema_columns(df: DataFrame, declared: T.StructType = TRADE_SCHEMA) -> DataFrame:
    """Declared columns in order, checked against the rows.

    Parquet tables enforce neither NOT NULL nor VARCHAR lengths, so NULLs and
    the longest value are measured, in one pass over the table.
    """
    measures = []
    for field in declared.fields:
        is_text = isinstance(field.dataType, T.StringType)
        longest = F.max(F.length(field.name)) if is_text else F.lit(None)
        measures += [
            F.count_if(F.col(field.name).isNull()).alias(f"{field.name}__nulls"),
            longest.cast("int").alias(f"{field.name}__longest"),
        ]
    rows = []
    for position, field in enumerate(declared.fields, 1):
        limit = field.metadata.get("max_length")
        nulls, longest = F.col(f"{field.name}__nulls"), F.col(f"{field.name}__longest")
        fits = (F.lit(field.nullable) | (nulls == 0)) & (
            F.coalesce(longest, F.lit(0)) <= F.lit(limit if limit else 2**31 - 1)
        )
        rows.append(
            F.struct(
                F.lit(position).alias("ordinal_position"),
                F.lit(field.name).alias("column_name"),
                F.lit(df.schema[field.name].dataType.simpleString()).alias("data_type"),
                F.lit("YES" if field.nullable else "NO").alias("is_nullable"),
                F.lit(limit).cast("int").alias("character_maximum_length"),
                F.lit(getattr(field.dataType, "precision", None)).cast("int").alias("numeric_precision"),
                nulls.alias("null_rows"),
                longest.alias("longest_value"),
                F.when(fits, "PASS").otherwise("FAIL").alias("result"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Schema drift, column by column, with the NULL count on either side."""
    source_types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    target_types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    names = list(dict.fromkeys([*source_types, *target_types]))

    def side(df: DataFrame, types: dict[str, str], tag: str) -> DataFrame:
        def entry(name: str):
            nulls = F.col(name) if name in types else F.lit(None).cast("bigint")
            return F.struct(
                F.lit(name).alias("column_name"),
                F.lit(types.get(name)).cast("string").alias(f"{tag}_type"),
                nulls.alias(f"{tag}_nulls"),
            )

        counts = [F.count_if(F.col(n).isNull()).alias(n) for n in names if n in types]
        return df.agg(*counts).select(F.inline(F.array(*[entry(n) for n in names])))

    same = F.col("source_type").eqNullSafe(F.col("target_type"))
    return (
        side(source, source_types, "source")
        .join(side(target, target_types, "target"), "column_name")
        .withColumn("result", F.when(same, "PASS").otherwise("FAIL"))
    )


def data_files(
    spark: SparkSession, path: str, keys: list[str] = PARTITION_COLUMNS
) -> DataFrame:
    """One row per data file: partition values, path, bytes, modification time.

    The binary-file source without its content column only lists files, so the
    cost follows the number of files, not the number of rows.
    """
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("modificationTime", T.TimestampType()),
            T.StructField("length", T.LongType()),
            T.StructField("content", T.BinaryType()),
            *[TRADE_SCHEMA[c] for c in keys],
        ]
    )
    reader = spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.parquet")
    found = versions.home(spark, path)
    if found is None:
        frames = [reader.load(path)]
    else:
        root, table = found
        reader = reader.option("basePath", path)
        frames = [
            reader.load([f"{path}/{p.at}" for p in own])
            for own in place_groups(versions.load(spark, root).of(table))
        ] or [reader.load(f"{root}/{versions.VERSIONS}")]  # it has no data files
    columns = [*keys, "path", F.col("length").alias("bytes"), "modificationTime"]
    listed = [frame.select(*columns) for frame in frames]
    return reduce(DataFrame.unionByName, listed)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per partition."""
    return data_files(spark, path).groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.min("bytes").alias("smallest_file_bytes"),
    )


def table_details(spark: SparkSession, table: str, json_path: str) -> DataFrame:
    """One value of a table's description, by JSON path."""
    described = spark.sql(f"DESCRIBE EXTENDED {table} AS JSON")
    return described.select(
        F.lit(table).alias("table_name"),
        F.get_json_object(F.col(described.columns[0]), json_path).alias("value"),
    )


def record_run(
    spark: SparkSession,
    path: str,
    name: str,
    state: str,
    scheduled: dt.datetime,
    error: str | None = None,
) -> None:
    """Append one run to the job-run log."""
    row = [(name, state, scheduled, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), error)]
    spark.createDataFrame(row, JOB_RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], JOB_RUN_SCHEMA)
    return spark.read.schema(JOB_RUN_SCHEMA).parquet(path)


def recent_runs(
    runs: DataFrame, name: str, now: dt.datetime, days: int = 1, limit: int = 5
) -> DataFrame:
    """The newest runs of a job that were scheduled in the last ``days`` days."""
    since = now - dt.timedelta(days=days)
    return (
        runs.where(
            (F.col("name") == name)
            & (F.col("scheduled_time") >= F.lit(since).cast("timestamp_ntz"))
            & (F.col("scheduled_time") <= F.lit(now).cast("timestamp_ntz"))
        )
        .orderBy(F.desc("scheduled_time"))
        .limit(limit)
    )
