"""The trade schema shared by every tier, and the domains the checks rely on."""

from __future__ import annotations

from pyspark.sql import types as T

# Column name, type, nullable, VARCHAR length.
TRADE_COLUMNS = [
    ("trade_id", T.StringType(), False, 36),
    ("trade_date", T.DateType(), False, None),
    ("trade_timestamp", T.TimestampNTZType(), False, None),
    ("asset_class", T.StringType(), False, 50),
    ("instrument_id", T.StringType(), False, 20),
    ("instrument_name", T.StringType(), True, 200),
    ("instrument_subtype", T.StringType(), True, 50),
    ("notional_usd", T.DecimalType(22, 4), False, None),
    ("notional_local", T.DecimalType(22, 4), True, None),
    ("local_currency", T.StringType(), True, 3),
    ("price", T.DecimalType(18, 8), True, None),
    ("quantity", T.DecimalType(20, 4), True, None),
    ("direction", T.StringType(), False, 4),
    ("counterparty_id", T.StringType(), True, 20),
    ("counterparty_lei", T.StringType(), True, 20),
    ("trader_id", T.StringType(), True, 20),
    ("book_id", T.StringType(), True, 20),
    ("desk_id", T.StringType(), True, 20),
    ("entity_id", T.StringType(), True, 20),
    ("trade_status", T.StringType(), True, 20),
    ("settlement_date", T.DateType(), True, None),
    ("value_date", T.DateType(), True, None),
    ("maturity_date", T.DateType(), True, None),
    ("uti", T.StringType(), True, 52),
    ("mifid_flag", T.BooleanType(), True, None),
    ("reporting_status", T.StringType(), True, 20),
    ("created_at", T.TimestampNTZType(), False, None),
    ("updated_at", T.TimestampNTZType(), True, None),
    ("source_system", T.StringType(), True, 50),
    ("trade_year", T.IntegerType(), False, None),
    ("trade_month", T.IntegerType(), False, None),
]

TRADE_SCHEMA = T.StructType(
    [
        T.StructField(name, dtype, nullable, {"max_length": length} if length else {})
        for name, dtype, nullable, length in TRADE_COLUMNS
    ]
)
COLUMNS = TRADE_SCHEMA.fieldNames()

# The pre-migration source carries no materialised partition columns.
PARTITION_COLUMNS = ["trade_year", "trade_month", "asset_class"]
LEGACY_COLUMNS = [c for c in COLUMNS if c not in ("trade_year", "trade_month")]
LEGACY_SCHEMA = T.StructType([TRADE_SCHEMA[c] for c in LEGACY_COLUMNS])

# The domains named by the data model.
ASSET_CLASSES = [
    "EQUITY", "FX", "RATES", "CREDIT", "COMMODITY", "DERIVATIVE",
    "STRUCTURED", "CRYPTO", "REPO", "LOAN", "OTHER",
]
DIRECTIONS = ["BUY", "SELL"]

# Columns covered by the row hash, in hash order.
HASH_COLUMNS = [
    "trade_id", "trade_date", "trade_timestamp", "asset_class", "instrument_id",
    "notional_usd", "direction", "counterparty_id", "trader_id", "book_id",
    "trade_status",
]

MIGRATION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("migration_run_id", T.StringType(), False),
        T.StructField("source_table", T.StringType(), False),
        T.StructField("target_table", T.StringType(), False),
        T.StructField("partition_start", T.DateType(), False),
        T.StructField("partition_end", T.DateType(), False),
        T.StructField("rows_migrated", T.LongType(), False),
        T.StructField("migration_ts", T.TimestampNTZType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("notes", T.StringType(), True),
    ]
)

JOB_RUN_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("scheduled_time", T.TimestampNTZType(), False),
        T.StructField("completed_time", T.TimestampNTZType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)
