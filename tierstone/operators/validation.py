"""Five validation levels that compare a source window with a target partition.

Every function takes the two sides already cut to the window; the source should
be the snapshot that was migrated, not the live table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions.hashing import row_hash, sample_order
from tierstone.functions.verdicts import same_within, verdict
from tierstone.operators import wording
from tierstone.schema import DIRECTIONS, HASH_COLUMNS
from tierstone.sources.scans import month_partition, month_window

TOLERANCE = "0.01"
SAMPLE_ROWS = 1000
MOST_SAMPLED = 100_000
DUPLICATE_LIMIT = 50

# Alias and column of the NULL counts, and those the verdict uses.
NULL_CHECKS = [
    ("null_trade_id", "trade_id"),
    ("null_trade_date", "trade_date"),
    ("null_trade_ts", "trade_timestamp"),
    ("null_asset_class", "asset_class"),
    ("null_notional", "notional_usd"),
    ("null_direction", "direction"),
    ("null_trade_year", "trade_year"),
    ("null_trade_month", "trade_month"),
    ("null_created_at", "created_at"),
]
MONEY = "decimal(32,4)"


def both_sides(source: DataFrame, target: DataFrame, *columns: str | Column) -> DataFrame:
    """Both sides stacked and tagged, so one aggregate can compare them."""
    return source.select(F.lit("S").alias("side"), *columns).unionByName(
        target.select(F.lit("T").alias("side"), *columns)
    )


def on(side: str, value: Column) -> Column:
    return F.when(F.col("side") == side, value)


def rows_on(side: str) -> Column:
    return F.count_if(F.col("side") == side)


def wrong_partition() -> Column:
    return (F.year("trade_date") != F.col("trade_year")) | (
        F.month("trade_date") != F.col("trade_month")
    )


def bad_direction() -> Column:
    """NULL directions are not reported here, as in ``NOT IN``."""
    return ~F.col("direction").isin(DIRECTIONS)


def short_id() -> Column:
    """A trade id in fewer bytes: hex digits as half as many, other ids as they are. The first
    byte tells them apart, so two ids are equal if these are."""
    text = F.col("trade_id")
    return F.when(
        text.rlike("^([0-9a-f]{2})+$"), F.concat(F.unhex(F.lit("01")), F.unhex(text))
    ).otherwise(F.concat(F.unhex(F.lit("00")), text.cast("binary")))


# Level 2 -----------------------------------------------------------------


def row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    counted = both_sides(source, target).agg(
        rows_on("S").alias("source_rows"), rows_on("T").alias("target_rows")
    )
    delta = F.col("source_rows") - F.col("target_rows")
    return counted.withColumn("delta", delta).withColumn(
        "result",
        verdict(
            F.col("delta") == 0,
            wording.ROWS_PASS,
            F.concat(F.lit(wording.ROWS_FAIL), F.col("delta").cast("string")),
        ),
    )


def _key_counts(target: DataFrame) -> DataFrame:
    return target.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("trade_id").alias("ids")
    )


def duplicate_check(target: DataFrame) -> DataFrame:
    extra = F.col("rows") - F.col("ids")
    return _key_counts(target).select(
        verdict(
            extra == 0,
            wording.UNIQUE_PASS,
            F.concat(F.lit(wording.UNIQUE_FAIL), extra.cast("string")),
        ).alias("result")
    )


def duplicates(target: DataFrame, limit: int = DUPLICATE_LIMIT) -> DataFrame:
    """The most repeated ids; the id breaks ties."""
    return (
        target.groupBy("trade_id")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .orderBy(F.desc("occurrences"), "trade_id")
        .limit(limit)
    )


# Level 3 -----------------------------------------------------------------


def _sum_on(side: str, column: str) -> Column:
    return F.sum(on(side, F.col(column))).cast(MONEY)


def notional_sum(source: DataFrame, target: DataFrame) -> DataFrame:
    """Sums and date range; two empty sides agree."""
    summed = both_sides(source, target, "notional_usd", "quantity", "trade_date").agg(
        _sum_on("S", "notional_usd").alias("src_notional"),
        _sum_on("T", "notional_usd").alias("tgt_notional"),
        _sum_on("S", "quantity").alias("src_quantity"),
        _sum_on("T", "quantity").alias("tgt_quantity"),
        F.min(on("S", F.col("trade_date"))).alias("src_min_date"),
        F.min(on("T", F.col("trade_date"))).alias("tgt_min_date"),
        F.max(on("S", F.col("trade_date"))).alias("src_max_date"),
        F.max(on("T", F.col("trade_date"))).alias("tgt_max_date"),
    )
    agree = (
        same_within(F.col("src_notional"), F.col("tgt_notional"), TOLERANCE)
        & same_within(F.col("src_quantity"), F.col("tgt_quantity"), TOLERANCE)
        & F.col("src_min_date").eqNullSafe(F.col("tgt_min_date"))
        & F.col("src_max_date").eqNullSafe(F.col("tgt_max_date"))
    )
    return summed.withColumn(
        "abs_delta", F.abs(F.col("src_notional") - F.col("tgt_notional")).cast("decimal(33,4)")
    ).withColumn("result", verdict(agree, wording.SUMS_PASS, wording.SUMS_FAIL))


def null_check(target: DataFrame) -> DataFrame:
    counted = target.agg(
        *[F.count_if(F.col(column).isNull()).alias(alias) for alias, column in NULL_CHECKS]
    )
    clean = reduce(lambda a, b: a & b, [F.col(alias) == 0 for alias, _ in NULL_CHECKS])
    return counted.withColumn(
        "result",
        verdict(
            clean,
            wording.NULLS_PASS,
            wording.NULLS_FAIL,
        ),
    )


def bad_directions(target: DataFrame) -> DataFrame:
    return (
        target.where(bad_direction()).groupBy("direction").agg(F.count(F.lit(1)).alias("occurrences"))
    )


def partition_consistency(target: DataFrame) -> DataFrame:
    return target.agg(F.count_if(wrong_partition()).alias("mismatched_partition_columns"))


# Level 4 -----------------------------------------------------------------


def _grouped(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def asset_class_distribution(source: DataFrame, target: DataFrame) -> DataFrame:
    """A class missing on one side counts 0 there, so the verdict is never NULL."""
    joined = _grouped(source, "asset_class", "src_count").join(
        _grouped(target, "asset_class", "tgt_count"), "asset_class", "full_outer"
    )
    counted = joined.select(
        "asset_class",
        F.coalesce("src_count", F.lit(0)).alias("src_count"),
        F.coalesce("tgt_count", F.lit(0)).alias("tgt_count"),
    )
    delta = F.col("src_count") - F.col("tgt_count")
    return counted.withColumn(
        "result",
        verdict(delta == 0, "PASS ✓", F.concat(F.lit("FAIL ✗ delta="), delta.cast("string"))),
    ).orderBy("asset_class")


def class_profile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows per class on either side, one under the other."""
    sides = [(source, "SOURCE"), (target, "TARGET")]
    tagged = [
        _grouped(df, "asset_class", "row_count").select(
            F.lit(tag).alias("data_source"), "asset_class", "row_count"
        )
        for df, tag in sides
    ]
    return tagged[0].unionByName(tagged[1]).orderBy("data_source", "asset_class")


def daily_profile(source: DataFrame, target: DataFrame, how: str = "left") -> DataFrame:
    """Rows per day; ``full_outer`` also reports days found only in the target."""
    joined = _grouped(source, "trade_date", "src_daily_count").join(
        _grouped(target, "trade_date", "tgt_daily_count"), "trade_date", how
    )
    delta = F.coalesce("src_daily_count", F.lit(0)) - F.coalesce("tgt_daily_count", F.lit(0))
    return joined.select(
        "trade_date",
        "src_daily_count",
        "tgt_daily_count",
        delta.alias("delta"),
        verdict(delta == 0, "PASS ✓", "FAIL ✗").alias("result"),
    ).orderBy("trade_date")


# Level 5 -----------------------------------------------------------------


def sample_ids(source: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """A reproducible sample, planned as a top-k rather than a full sort."""
    return source.orderBy(sample_order(seed=seed), "trade_id").limit(rows).select("trade_id")


def drawn(sample: DataFrame) -> DataFrame:
    """The sampled ids, drawn once for several look-ups: a local table, ``MOST_SAMPLED`` lines
    at most."""
    ids = sample.limit(MOST_SAMPLED + 1).collect()
    if len(ids) > MOST_SAMPLED:
        raise ValueError(f"a sample of more than {MOST_SAMPLED} ids is no sample")
    return sample.sparkSession.createDataFrame(ids, sample.schema)


def hashed_rows(table: DataFrame, sample: DataFrame) -> DataFrame:
    """Row hashes of the sampled ids; the sample is at most ``SAMPLE_ROWS`` ids."""
    return (
        table.join(F.broadcast(sample.distinct()), "trade_id", "left_semi")
        .select("trade_id", row_hash(HASH_COLUMNS).alias("row_hash"))
    )


def sample_hash_check(source: DataFrame, target: DataFrame, sample: DataFrame) -> DataFrame:
    """Sampled source rows against all target rows of the same id.

    The counts are those of a left join on the id. They are computed from the
    number of copies per id and hash, so copies are never paired up.
    """
    copies = (
        both_sides(hashed_rows(source, sample), hashed_rows(target, sample), "trade_id", "row_hash")
        .groupBy("trade_id", "row_hash")
        .agg(rows_on("S").alias("src"), rows_on("T").alias("tgt"))
    )
    by_id = copies.groupBy("trade_id").agg(
        F.sum("src").alias("src"),
        F.sum("tgt").alias("tgt"),
        F.sum(F.col("src") * F.col("tgt")).alias("matching"),
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    counted = by_id.agg(
        total(F.col("src") * F.greatest("tgt", F.lit(1))).alias("total_sampled"),
        total(F.col("matching")).alias("matching_rows"),
        total(F.col("src") * F.col("tgt") - F.col("matching")).alias("mismatched_rows"),
        total(F.when(F.col("tgt") == 0, F.col("src")).otherwise(0)).alias("missing_in_target"),
    )
    return counted.withColumn(
        "result",
        verdict(
            (F.col("mismatched_rows") == 0) & (F.col("missing_in_target") == 0),
            failed=wording.SAMPLE_FAIL,
        ),
    ).withColumn(
        "result",
        F.when(
            F.col("result") == "PASS",
            F.concat(
                F.lit(wording.SAMPLE_PASS_BEFORE),
                F.col("total_sampled").cast("string"),
                F.lit(wording.SAMPLE_PASS_AFTER),
            ),
        ).otherwise(F.col("result")),
    )


# All levels --------------------------------------------------------------

REPORT = ["level", "check_id", "source_value", "target_value", "delta", "result"]


def _line(
    level: int, check: str, result: Column, source=None, target=None, delta=None
) -> Column:
    def text(value) -> Column:
        return (F.lit(None) if value is None else value).cast("string")

    return F.struct(
        F.lit(level).alias("level"),
        F.lit(check).alias("check_id"),
        text(source).alias("source_value"),
        text(target).alias("target_value"),
        text(delta).alias("delta"),
        result.alias("result"),
    )


def _profile(source: DataFrame, target: DataFrame) -> DataFrame:
    """One small row per side, day and class that answers levels 2 to 4."""
    columns = [c for _, c in NULL_CHECKS] + ["quantity"]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for _, c in NULL_CHECKS])
    return (
        both_sides(source, target, *columns)
        .groupBy("side", "trade_date", "asset_class")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("notional_usd").alias("notional"),
            F.sum("quantity").alias("quantity"),
            F.count_if(any_null).alias("null_rows"),
            F.count_if(bad_direction()).alias("bad_directions"),
            F.count_if(wrong_partition()).alias("misplaced"),
        )
    )


def _compared(profile: DataFrame) -> DataFrame:
    """One row with everything levels 2 to 4 compare.

    Grouping sets turn the profile into totals, classes and days at once, so
    either side is scanned a single time for all of these checks.
    """

    def total(side: str, column: str, dtype: str = "bigint") -> Column:
        return F.sum(on(side, F.col(column))).cast(dtype)

    measures = {
        "src_rows": F.coalesce(total("S", "rows"), F.lit(0)),
        "tgt_rows": F.coalesce(total("T", "rows"), F.lit(0)),
        "src_notional": total("S", "notional", MONEY),
        "tgt_notional": total("T", "notional", MONEY),
        "src_quantity": total("S", "quantity", MONEY),
        "tgt_quantity": total("T", "quantity", MONEY),
        "src_min": F.min(on("S", F.col("trade_date"))),
        "tgt_min": F.min(on("T", F.col("trade_date"))),
        "src_max": F.max(on("S", F.col("trade_date"))),
        "tgt_max": F.max(on("T", F.col("trade_date"))),
        "null_rows": F.coalesce(total("T", "null_rows"), F.lit(0)),
        "bad_directions": F.coalesce(total("T", "bad_directions"), F.lit(0)),
        "misplaced": F.coalesce(total("T", "misplaced"), F.lit(0)),
    }
    day, cls = F.col("day"), F.col("asset_class")
    grouped = (
        profile.withColumn("day", F.col("trade_date"))
        .groupingSets([[], [cls], [day]], cls, day)
        .agg(
            F.grouping(cls).alias("not_class"),
            F.grouping(day).alias("not_day"),
            *[measure.alias(name) for name, measure in measures.items()],
        )
    )
    overall = (F.col("not_class") == 1) & (F.col("not_day") == 1)
    differs = F.col("src_rows") != F.col("tgt_rows")
    zero = {"src_rows", "tgt_rows", "null_rows", "bad_directions", "misplaced"}

    def of_overall(name: str) -> Column:
        value = F.max(F.when(overall, F.col(name)))
        return (F.coalesce(value, F.lit(0)) if name in zero else value).alias(name)

    def keyed(tag: str, kind: Column) -> list[Column]:
        return [
            F.count_if(kind & (F.col("src_rows") > 0)).alias(f"{tag}_src"),
            F.count_if(kind & (F.col("tgt_rows") > 0)).alias(f"{tag}_tgt"),
            F.count_if(kind & differs).alias(f"{tag}_mismatches"),
        ]

    return grouped.agg(
        *[of_overall(name) for name in measures],
        *keyed("class", F.col("not_class") == 0),
        *keyed("day", F.col("not_day") == 0),
    )


def validate_partition(
    source: DataFrame,
    target: DataFrame,
    year: int,
    month: int,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 42,
) -> DataFrame:
    """The report of levels 2 to 5 for one month, one line per check.

    Sampled ids are looked up in the whole target.
    """
    src, tgt = month_window(source, year, month), month_partition(target, year, month)
    col = F.col
    sums_agree = (
        same_within(col("src_notional"), col("tgt_notional"), TOLERANCE)
        & same_within(col("src_quantity"), col("tgt_quantity"), TOLERANCE)
        & col("src_min").eqNullSafe(col("tgt_min"))
        & col("src_max").eqNullSafe(col("tgt_max"))
    )

    def keyed(check: str, tag: str) -> Column:
        mismatches = col(f"{tag}_mismatches")
        return _line(
            4, check, verdict(mismatches == 0), col(f"{tag}_src"), col(f"{tag}_tgt"), mismatches
        )

    compared = _compared(_profile(src, tgt)).select(
        F.inline(
            F.array(
                _line(
                    2, "V2.1", verdict(col("src_rows") == col("tgt_rows")),
                    col("src_rows"), col("tgt_rows"), col("src_rows") - col("tgt_rows"),
                ),
                _line(
                    3, "V3.1", verdict(sums_agree),
                    col("src_notional"), col("tgt_notional"),
                    F.abs(col("src_notional") - col("tgt_notional")).cast("decimal(33,4)"),
                ),
                _line(3, "V3.2", verdict(col("null_rows") == 0), target=col("null_rows")),
                _line(3, "V3.3", verdict(col("bad_directions") == 0), target=col("bad_directions")),
                _line(3, "V3.4", verdict(col("misplaced") == 0), target=col("misplaced")),
                keyed("V4.1", "class"),
                keyed("V4.2", "day"),
            )
        )
    )
    surplus = col("rows") - col("ids")
    unique = _key_counts(tgt).select(
        F.inline(F.array(_line(2, "V2.2", verdict(surplus == 0), target=col("rows"), delta=surplus)))
    )
    unmatched = col("mismatched_rows") + col("missing_in_target")
    sample = drawn(sample_ids(src, sample_rows, seed))
    hashes = sample_hash_check(source, target, sample).select(
        F.inline(
            F.array(
                _line(
                    5, "V5.4", verdict(unmatched == 0),
                    col("total_sampled"), col("matching_rows"), unmatched,
                )
            )
        )
    )
    return reduce(DataFrame.unionByName, [compared, unique, hashes]).select(*REPORT)


def validate_all_partitions(source: DataFrame, target: DataFrame) -> DataFrame:
    """Volume and content checks for every month of both tables, in one job.

    The source is keyed by its dates, the target by its partition columns.
    Uniqueness is measured on the target ids of each month.
    """
    dated = source.withColumns(
        {"trade_year": F.year("trade_date"), "trade_month": F.month("trade_date")}
    )
    columns = ["trade_date", "notional_usd", "quantity", "trade_year", "trade_month"]
    months = both_sides(dated, target, *columns).groupBy("trade_year", "trade_month")
    summed = months.agg(
        rows_on("S").alias("source_rows"),
        rows_on("T").alias("target_rows"),
        _sum_on("S", "notional_usd").alias("source_notional"),
        _sum_on("T", "notional_usd").alias("target_notional"),
        _sum_on("S", "quantity").alias("source_quantity"),
        _sum_on("T", "quantity").alias("target_quantity"),
        F.coalesce(
            F.count_if((F.col("side") == "T") & wrong_partition()), F.lit(0)
        ).alias("misplaced_rows"),
    )
    # ids alone cross the shuffle, without the sums of their rows
    ids = target.groupBy(
        F.col("trade_year").alias("_year"), F.col("trade_month").alias("_month")
    ).agg(F.count_distinct(short_id()).alias("target_ids"))
    same_month = F.col("trade_year").eqNullSafe(F.col("_year")) & F.col("trade_month").eqNullSafe(
        F.col("_month")
    )
    checked = summed.join(ids, same_month, "left").select(
        "trade_year", "trade_month", "source_rows", "target_rows",
        F.coalesce("target_ids", F.lit(0)).alias("target_ids"),
        "source_notional", "target_notional", "source_quantity", "target_quantity",
        "misplaced_rows",
    )
    passed = (
        (F.col("source_rows") == F.col("target_rows"))
        & (F.col("target_rows") == F.col("target_ids"))
        & same_within(F.col("source_notional"), F.col("target_notional"), TOLERANCE)
        & same_within(F.col("source_quantity"), F.col("target_quantity"), TOLERANCE)
        & (F.col("misplaced_rows") == 0)
    )
    return checked.withColumn("result", verdict(passed))


def sign_off(year: int, month: int, checked: DataFrame) -> DataFrame:
    """The closing line for a partition, with the number of rows it speaks for."""
    name = F.concat(F.lit(str(year)), F.lit("-"), F.lpad(F.lit(str(month)), 2, "0"))
    return checked.agg(F.count(F.lit(1)).alias("rows_checked")).select(
        F.concat(
            F.lit(wording.SIGN_OFF_BEFORE),
            name,
            F.lit(wording.SIGN_OFF_AFTER),
        ).alias("sign_off_reminder"),
        "rows_checked",
    )
