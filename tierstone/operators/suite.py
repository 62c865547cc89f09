"""The post-migration suite and the pre-flight checks of the source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tierstone.functions.dates import calendar_months_between
from tierstone.functions.verdicts import verdict
from tierstone.operators.validation import bad_direction, wrong_partition
from tierstone.operators import wording
from tierstone.schema import ASSET_CLASSES, COLUMNS


@dataclass(frozen=True)
class Check:
    description: str
    observed: Column
    passes: Callable[[Column], Column]


def _zero(value: Column) -> Column:
    return value == 0


def _check_line(check_id: str, check: Check) -> Column:
    value = F.col(check_id).cast("bigint")
    return F.struct(
        F.lit(check_id).alias("check_id"),
        F.lit(check.description).alias("description"),
        value.alias("observed"),
        verdict(check.passes(value)).alias("result"),
    )


def _run(df: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """All checks in one aggregate, one line per check."""
    measured = df.agg(*[check.observed.alias(name) for name, check in checks.items()])
    return measured.select(
        F.inline(F.array(*[_check_line(name, check) for name, check in checks.items()]))
    )


def table_checks(start: dt.date, end: dt.date) -> dict[str, Check]:
    """Checks of the cold table that one grouped profile answers.

    The profile has a row per year and class, so counting distinct years and
    classes on it needs no extra shuffle of the table.
    """
    in_range = F.col("trade_year").between(start.year, end.year)
    years = end.year - start.year + 1
    # Check ids, descriptions and pass rules.
    return {
        "V-001": Check(
            "Total row count > 0 in TRADES_COLD",
            F.coalesce(F.sum(F.when(in_range, F.col("rows"))), F.lit(0)),
            lambda v: v > 0,
        ),
        "V-002": Check(
            "All expected years present in TRADES_COLD",
            F.count_distinct(F.when(in_range, F.col("trade_year"))),
            lambda v: v == years,
        ),
        "V-003": Check("No NULL trade_id values in TRADES_COLD", F.sum("null_ids"), _zero),
        "V-005": Check(
            "All 11 expected asset classes present",
            F.count_distinct("asset_class"),
            lambda v: v == len(ASSET_CLASSES),
        ),
        "C-001": Check("No NULL notional_usd values", F.sum("null_notionals"), _zero),
        "C-002": Check("All direction values are BUY or SELL", F.sum("bad_directions"), _zero),
        "C-003": Check("Partition columns consistent with trade_date", F.sum("misplaced"), _zero),
        "C-004": Check(
            "Notional values are positive (no negative notional)", F.sum("not_positive"), _zero
        ),
        "C-005": Check("No future-dated trades in cold tier", F.sum("future_dated"), _zero),
    }


def _table_profile(cold: DataFrame, as_of: dt.date) -> DataFrame:
    return cold.groupBy("trade_year", "asset_class").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("trade_id").isNull()).alias("null_ids"),
        F.count_if(F.col("notional_usd").isNull()).alias("null_notionals"),
        F.count_if(bad_direction()).alias("bad_directions"),
        F.count_if(wrong_partition()).alias("misplaced"),
        F.count_if(F.col("notional_usd") <= 0).alias("not_positive"),
        F.count_if(F.col("trade_date") > F.lit(as_of)).alias("future_dated"),
    )


def check_table(
    cold: DataFrame,
    start: dt.date,
    end: dt.date,
    as_of: dt.date,
    only: Iterable[str] | None = None,
) -> DataFrame:
    checks = table_checks(start, end)
    wanted = set(checks if only is None else only)
    chosen = {k: v for k, v in checks.items() if k in wanted}
    # An empty table has no profile rows, and its sums are NULL rather than 0.
    zeroed = {
        k: Check(c.description, F.coalesce(c.observed, F.lit(0)), c.passes) for k, c in chosen.items()
    }
    return _run(_table_profile(cold, as_of), zeroed)


def check_unique(cold: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    surplus = F.count(F.lit(1)) - F.count_distinct("trade_id")
    in_range = cold.where(F.col("trade_year").between(start.year, end.year))
    return _run(in_range, {"V-004": Check("No duplicate trade_id in TRADES_COLD", surplus, _zero)})


def check_log_complete(log: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    expected = (end.year - start.year) * 12 + end.month - start.month + 1
    completed = log.where(
        (F.col("status") == "COMPLETED")
        & (F.col("partition_start") >= F.lit(start))
        & (F.col("partition_end") <= F.lit(end))
    )
    check = Check(
        "Migration log has entries for all months",
        F.count_distinct("partition_start"),
        lambda v: v >= expected,
    )
    return _run(completed, {"L-001": check})


def check_log_failed(log: DataFrame, start: dt.date) -> DataFrame:
    failed = log.where((F.col("status") == "FAILED") & (F.col("partition_start") >= F.lit(start)))
    return _run(failed, {"L-002": Check("No failed migrations in log", F.count(F.lit(1)), _zero)})


def check_view(unified: DataFrame, start: dt.date) -> DataFrame:
    rows = unified.where(F.col("trade_year") == start.year)
    check = Check(
        "V_ALL_TRADES returns results without error", F.count(F.lit(1)), lambda v: v > 0
    )
    return _run(rows, {"Q-001": check})


def check_pruned(cold: DataFrame, start: dt.date, month: int = 1, asset_class: str = "FX") -> DataFrame:
    """Partitions left after pruning to one year, month and class: some, but not all."""
    wanted = (
        (F.col("trade_year") == start.year)
        & (F.col("trade_month") == month)
        & (F.col("asset_class") == asset_class)
    )
    partitions = cold.select("trade_year", "trade_month", "asset_class").distinct()
    counted = partitions.agg(
        F.count_if(wanted).alias("scanned"), F.count(F.lit(1)).alias("total")
    )
    return counted.select(
        F.lit("Q-002").alias("check_id"),
        F.lit("Partition pruning works for a single asset class").alias("description"),
        F.col("scanned").alias("observed"),
        verdict((F.col("scanned") > 0) & (F.col("scanned") < F.col("total"))).alias("result"),
    )


def check_structure(cold: DataFrame, found: dict[str, bool]) -> DataFrame:
    """Existence of the tier tables and the view, and the cold column count."""
    spark = cold.sparkSession
    # Check ids, descriptions and expected counts.
    names = {
        "S-001": ("TRADES_COLD table exists", int(found["trades_cold"]), 1),
        "S-002": ("TRADES_WARM table exists", int(found["trades_warm"]), 1),
        "S-003": ("Unified view V_ALL_TRADES exists", int(found["v_all_trades"]), 1),
        "S-004": (
            "TRADES_COLD column count matches expected (31 columns)",
            len(cold.columns),
            len(COLUMNS),
        ),
    }
    rows = [
        (check_id, text, observed, "PASS" if observed == expected else "FAIL")
        for check_id, (text, observed, expected) in names.items()
    ]
    return spark.createDataFrame(
        rows, "check_id string, description string, observed bigint, result string"
    )


def validate_migration(
    cold: DataFrame,
    unified: DataFrame,
    log: DataFrame,
    start: dt.date,
    end: dt.date,
    as_of: dt.date,
    found: dict[str, bool],
    fail_fast: bool = False,
) -> DataFrame:
    """All eighteen checks, whatever the others found.

    With ``fail_fast`` the stages run one after the other, the cheap ones first, and none is
    begun after one with a failed check; the report then ends with that stage.
    """
    stages = [
        lambda: check_structure(cold, found),
        lambda: check_log_complete(log, start, end),
        lambda: check_log_failed(log, start),
        lambda: check_pruned(cold, start),
        lambda: check_view(unified, start),
        lambda: check_table(cold, start, end, as_of),
        lambda: check_unique(cold, start, end),
    ]
    if not fail_fast:
        return reduce(DataFrame.unionByName, [stage() for stage in stages])
    lines: list[Row] = []
    for stage in stages:
        lines += stage().collect()  # a line per check
        if any(line["result"] != "PASS" for line in lines):
            break
    return cold.sparkSession.createDataFrame(
        lines, "check_id string, description string, observed bigint, result string"
    )


def suite_summary(checks: DataFrame) -> DataFrame:
    """Accounting of a suite run: all checks must pass."""
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("result") == "PASS").alias("passed"),
        F.count_if(F.col("result") != "PASS").alias("failed"),
    ).withColumn("result", verdict(F.col("failed") == 0))


def write_report(checks: DataFrame, path: str, fmt: str = "json") -> None:
    """The report as one small file: it holds a line per check."""
    checks.coalesce(1).write.mode("overwrite").format(fmt).save(path)


# Pre-flight --------------------------------------------------------------


def preflight_source(source: DataFrame) -> DataFrame:
    return source.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("trade_date").alias("earliest_date"),
        F.max("trade_date").alias("latest_date"),
    ).select(
        "*",
        (calendar_months_between(F.col("earliest_date"), F.col("latest_date")) + 1).alias(
            "months_to_migrate"
        ),
        verdict(
            F.col("total_rows") > 0,
            wording.SOURCE_PASS,
            wording.SOURCE_FAIL,
        ).alias("source_check"),
    )


def preflight_duplicates(source: DataFrame) -> DataFrame:
    extra = F.col("rows") - F.col("ids")
    return source.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("trade_id").alias("ids")
    ).select(
        verdict(
            extra == 0,
            wording.COPIES_PASS,
            F.concat(
                F.lit(wording.COPIES_FAIL_BEFORE),
                extra.cast("string"),
                F.lit(wording.COPIES_FAIL_AFTER),
            ),
        ).alias("duplicate_check")
    )
