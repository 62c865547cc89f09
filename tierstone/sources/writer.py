"""Writing partitioned trade tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierstone.schema import COLUMNS, PARTITION_COLUMNS
from tierstone.sources import versions
from tierstone.sources.scans import empty_trades, read_places, read_trades
from tierstone.sources.storage import delete, stored_bytes

SHUFFLE_BYTES = 64 * 1024 * 1024
ROW_EXPANSION = 3
#: What a task that writes reads: from a shuffle of wide rows, from one of narrow rows, and from
#: files. A row in memory is three to ten times as large as stored, and sorting must not spill
#: beside three other tasks of an executor.
FILE_BYTES = "128m"
NARROW_BYTES = "48m"
READ_BYTES = "48m"
TASK_BYTES = 128 * 1024 * 1024
SMALLEST_TASK = "64k"
FOLDER_CALLS = 16
#: Rows that are laid out at once; their shuffle, about a gigabyte, is gone before the next.
SLICE_ROWS = 4_000_000
# Fixed value: shuffle files are deleted at the end of a query, not when the driver collects garbage.
CLEAN = {"classic__shuffleDependency__fileCleanup__enabled": "true"}
# Fixed value: the frames of a union keep their own tasks, also if each has only one.
OWN_TASKS = {"unionOutputPartitioning": "false"}


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the queries planned inside, restored afterwards."""
    names = {key: "spark.sql." + key.replace("__", ".") for key in values}
    before = {name: spark.conf.get(name, None) for name in names.values()}
    for key, value in values.items():
        spark.conf.set(names[key], value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def writing(spark: SparkSession, task_bytes: str | None = None):
    """Settings of a table write: tasks by ``task_bytes``, ``FILE_BYTES`` if not given, reads by
    ``READ_BYTES``.

    The small minimum only matters below that much per core, where it lets
    a small write use all cores. The shuffle files of a write go when it ends.
    """
    return settings(
        spark,
        adaptive__advisoryPartitionSizeInBytes=task_bytes or FILE_BYTES,
        adaptive__coalescePartitions__minPartitionSize=SMALLEST_TASK,
        files__maxPartitionBytes=READ_BYTES,
        **CLEAN,
    )


def enough_shuffle_partitions(spark: SparkSession, input_bytes: int) -> str:
    """Shuffle partitions of about ``SHUFFLE_BYTES`` for that much Parquet.

    Never fewer than the session asks for; adaptive execution merges the rest.
    """
    wanted = -(-input_bytes * ROW_EXPANSION // SHUFFLE_BYTES)
    return str(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def laid_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows gathered by partition key and sorted for file statistics.

    REBALANCE lets adaptive execution split a key that holds a large share of
    the rows over several tasks and merge small keys into one, by bytes.
    Sorting by counterparty keeps that column's ranges narrow per row group,
    which is what serves lookups on a column too fine to partition by.
    """
    return in_order(df.hint("rebalance", *keys), keys)


def in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted in their tasks as ``laid_out`` sorts them."""
    return rows.sortWithinPartitions(*keys, "counterparty_id", "trade_id")


def in_slices(rows: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Rows cut by ranges of days, or of months where days are no key, into about
    ``SLICE_ROWS`` each, one partition at least. Rows without a day are in the first slice.

    Laid out one after the other they need the disk of one shuffle of that size. Their plan is
    run once for the number of rows of each day and once for each slice, so its inputs must be
    stored and its joins narrow.
    """
    day = F.col("trade_date")
    unit = day if "trade_date" in keys else F.trunc("trade_date", "month")
    counted = rows.where(day.isNotNull()).groupBy(unit.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    cuts, size = [], 0
    for found in sorted(counted.collect()):  # at most the days of the calendar
        if size and size + found["n"] > SLICE_ROWS:
            cuts.append(found["day"])
            size = 0
        size += found["n"]
    if not cuts:
        return [rows]
    return [
        rows.where((day < cuts[0]) | day.isNull()),
        *[rows.where((day >= start) & (day < end)) for start, end in zip(cuts, cuts[1:])],
        rows.where(day >= cuts[-1]),
    ]


def gathered_places(
    spark: SparkSession, path: str, places: list[versions.Place], file_bytes: int | None = None
) -> DataFrame:
    """The rows of some places, not sorted, with those of a partition in one task and without
    a shuffle.

    A task reads whole partition folders, about ``READ_BYTES`` of them; one with more than
    ``file_bytes``, ``READ_BYTES`` if not given, is read in parts. The plan has a scan for every
    such group, so it is bounded by the folders.
    """
    folders: dict[str, list[versions.Place]] = {}
    for place in sorted(places, key=lambda p: (p.folder, p.at)):
        folders.setdefault(place.folder, []).append(place)
    if not folders:
        return empty_trades(spark)

    def size_of(own: list[versions.Place]) -> int:
        return stored_bytes(spark, [f"{path}/{p.at}" for p in own])

    with ThreadPoolExecutor(FOLDER_CALLS) as pool:
        sizes = list(pool.map(size_of, folders.values()))
    task_bytes = int(READ_BYTES.rstrip("m")) * 1024 * 1024
    file_bytes = file_bytes or task_bytes
    even = -(-sum(sizes) // spark.sparkContext.defaultParallelism)
    most = min(task_bytes, file_bytes, even)
    groups: list[tuple[list[versions.Place], int]] = []
    for own, size in zip(folders.values(), sizes):
        if groups and groups[-1][1] + size <= most:
            groups[-1] = [*groups[-1][0], *own], groups[-1][1] + size
        else:
            groups.append((own, size))
    frames = [
        read_places(spark, path, own).coalesce(max(1, -(-size // file_bytes)))
        for own, size in groups
    ]
    return reduce(DataFrame.unionByName, frames)


def spread_places(
    spark: SparkSession,
    path: str,
    places: list[versions.Place],
    target_bytes: int,
    at_least: int = 1,
) -> DataFrame:
    """``spread_by_size`` for stored partitions, without a shuffle: rows stay in the task that
    reads their partition, which is read in parts where ``target_bytes`` asks for several files.
    With ``at_least`` each task is so many, which read the same and write a share by row hash."""
    rows = gathered_places(spark, path, places, target_bytes * at_least)
    share = F.pmod(F.xxhash64(*COLUMNS), F.lit(at_least))
    parts = [rows.where(share == k) for k in range(at_least)] if at_least > 1 else [rows]
    return in_order(reduce(DataFrame.unionByName, parts), PARTITION_COLUMNS)


def gathered_copy(spark: SparkSession, path: str, keys: list[str] = PARTITION_COLUMNS) -> DataFrame:
    """The rows of a plain copy as ``laid_out`` gives them, without a shuffle."""
    folders = partition_folders(spark, path, len(keys))
    if not folders:
        return read_trades(spark, path)
    return in_order(gathered_places(spark, path, [versions.Place("", f, f) for f in folders]), keys)


def _save(
    df: DataFrame,
    path: str,
    mode: str,
    keys: list[str],
    id_filter: bool = False,
    task_bytes: str | None = None,
) -> None:
    """Parquet by partition key, in files of at most about a hundred megabytes.

    The advisory size is what a rebalanced task reads from the shuffle, which
    is the upper bound of what it writes. ``id_filter`` adds a bloom filter per
    row group, with which a lookup by id skips row groups that no range
    statistics can exclude; it costs about a megabyte per row group.
    """
    writer = df.write.mode(mode).option("compression", "zstd")
    if id_filter:
        writer = writer.option("parquet.bloom.filter.enabled#trade_id", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    with writing(df.sparkSession, task_bytes):
        writer.partitionBy(*keys).parquet(path)


def write_trades(
    df: DataFrame, path: str, keys: list[str] = PARTITION_COLUMNS, id_filter: bool = False
) -> None:
    _save(laid_out(df.select(*COLUMNS), keys), path, "errorifexists", keys, id_filter)


def write_by_month(
    df: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """A flat table whose files hold few months each, in date order.

    Date ranges then skip files and row groups by their statistics although
    the table has no partition columns. ``finish`` derives columns, and their order, from
    gathered rows, so that narrow ones cross the shuffle; the default sorts only.
    """
    month = F.year("trade_date") * 12 + F.month("trade_date")
    gathered = df.withColumn("_month", month).hint("rebalance", "_month").drop("_month")
    rows = finish(gathered) if finish else gathered.sortWithinPartitions("trade_date", "trade_id")
    with writing(df.sparkSession, NARROW_BYTES):
        rows.write.option("compression", "zstd").parquet(path)


def write_by_key(
    df: DataFrame, path: str, cell: Column, finish: Callable[[DataFrame], DataFrame]
) -> None:
    """A table with an id filter, by partition key, from narrow rows. ``cell`` numbers the
    partitions; ``finish`` derives columns, and their order, from gathered rows."""
    gathered = df.withColumn("_cell", cell).hint("rebalance", "_cell").drop("_cell")
    rows = finish(gathered).select(*COLUMNS)
    _save(rows, path, "errorifexists", PARTITION_COLUMNS, True, NARROW_BYTES)


def append_trades(df: DataFrame, path: str, keys: list[str] = PARTITION_COLUMNS) -> int:
    """Append by column name, never by position; returns the rows written."""
    return append_laid_out(laid_out(df.select(*COLUMNS), keys), path, keys)


def append_laid_out(rows: DataFrame, path: str, keys: list[str] = PARTITION_COLUMNS) -> int:
    """Append rows that are gathered and sorted already; returns the rows written.

    They are counted by the writing tasks themselves, after any exchange, where
    a task that has to run again is not counted twice. A table with versions gets a new one.
    The frames of a union keep their own tasks, also if each has only one.
    """
    written = Observation()
    spark, rows = rows.sparkSession, rows.select(*COLUMNS)
    found = versions.home(spark, path)
    if found:
        places, count = stage_trades(spark, rows, *found, keys)
        versions.commit(spark, found[0], [], places)
        return count
    with settings(spark, **OWN_TASKS):
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        _save(rows, path, "append", keys)
    return written.get["rows"]


def append_in_slices(df: DataFrame, path: str, keys: list[str] = PARTITION_COLUMNS) -> int:
    """``append_trades``, laid out a slice at a time; a table with versions gets one new one."""
    spark = df.sparkSession
    found, parts = versions.home(spark, path), in_slices(df, keys)
    if not found:
        return sum(append_trades(part, path, keys) for part in parts)
    staged = [stage_trades(spark, laid_out(part.select(*COLUMNS), keys), *found, keys) for part in parts]
    versions.commit(spark, found[0], [], [place for places, _ in staged for place in places])
    return sum(count for _, count in staged)


def copy_trades(
    df: DataFrame,
    path: str,
    keys: list[str] = PARTITION_COLUMNS,
    sort: bool = False,
    id_filter: bool = False,
) -> None:
    """An immutable copy on a new path; rows stay in the tasks that read them.

    From a table in date order, ``sort`` gives the files of ``write_trades`` without a shuffle.
    """
    rows = df.select(*COLUMNS)
    if sort:
        rows = in_order(rows, keys)
    with settings(df.sparkSession, **OWN_TASKS):
        _save(rows, path, "errorifexists", keys, id_filter)


def spread_by_size(
    df: DataFrame, sizes: DataFrame, target_bytes: int, at_least: int = 1
) -> DataFrame:
    """Rows in ``ceil(bytes / target)`` files per partition.

    ``sizes`` has one row per partition folder, at most a few tens of
    thousands, and is broadcast. Rows are dealt out by position in the scan,
    which a repeated task reproduces and which keeps copies of a row apart.
    A task holds about ``TASK_BYTES`` or one file; small partitions share one.
    """
    spark = df.sparkSession
    parts = sizes.select(
        *PARTITION_COLUMNS,
        F.greatest(F.ceil(F.col("bytes") / F.lit(target_bytes)), F.lit(at_least)).alias("_files"),
    )
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    task_bytes = min(target_bytes, TASK_BYTES)
    tasks = max(-(-total // task_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = (
        df.withColumn("_position", F.monotonically_increasing_id())
        .join(F.broadcast(parts), PARTITION_COLUMNS)
        .withColumn("_salt", F.pmod("_position", "_files"))
    )
    return (
        salted.repartition(tasks, *PARTITION_COLUMNS, "_salt")
        .sortWithinPartitions(*PARTITION_COLUMNS, "counterparty_id", "trade_id")
        .select(*COLUMNS)
    )


def standing_places(spark: SparkSession, path: str, depth: int) -> list[versions.Place]:
    """Where the partitions of a table are, ``depth`` key levels deep."""
    found = versions.home(spark, path)
    if found:
        return versions.load(spark, found[0]).of(found[1])
    return [versions.Place("", f, f) for f in versions.plain_folders(spark, path, depth)]


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative ``key=value`` folders of a table's partitions, ``depth`` levels deep."""
    return sorted({p.folder for p in standing_places(spark, path, depth)})


def drop_partitions(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Take out the partitions in and below some folders."""
    found = versions.home(spark, path)
    if found:
        root, table = found
        inside = tuple(f"{folder.rstrip('/')}/" for folder in folders)
        places = versions.load(spark, root).of(table)
        gone = [p for p in places if f"{p.folder}/".startswith(inside)]
        if gone:
            versions.commit(spark, root, gone, [])
        return
    with ThreadPoolExecutor(FOLDER_CALLS) as pool:
        list(pool.map(lambda folder: delete(spark, f"{path}/{folder}"), folders))


def stage_trades(
    spark: SparkSession, df: DataFrame, root: str, table: str, keys: list[str] = PARTITION_COLUMNS
) -> tuple[list[versions.Place], int]:
    """Write rows beside a table, where no reader sees them before a commit names their
    places; returns these and the number of rows."""
    run, written = versions.new_run(), Observation()
    rows = df.select(*COLUMNS).observe(written, F.count(F.lit(1)).alias("rows"))
    with settings(spark, **OWN_TASKS):
        _save(rows, f"{versions.table_path(root, table)}/{run}", "errorifexists", keys)
    return versions.run_places(spark, root, table, run, len(keys)), written.get["rows"]


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    folders: list[str],
    check: bool = True,
    keys: list[str] = PARTITION_COLUMNS,
) -> versions.Version:
    """Replace what ``df`` read in ``folders`` by the rows of ``df``, as one new version.

    Readers see all of it or nothing. Rows that other jobs add to these folders meanwhile
    stay; if one replaces or drops the same rows first, this raises ``versions.Conflict`` and
    nothing has happened, as when the run dies. The old files stay until ``versions.vacuum``.
    """
    # files are found by name in what stands now, so df may have been planned before
    root, table = versions.home(spark, path) or (path, "")
    start = versions.begin(spark, root, {table: len(keys)})
    read = {file.rsplit("/", 1)[-1] for file in df.inputFiles()}
    files = versions.files_of(spark, root, start.of(table, folders))
    old = [p for p, names in files.items() if not read.isdisjoint(names)]
    if not old:
        raise ValueError("the rows were not read from the partitions that they replace")
    added, _ = stage_trades(spark, df, root, table, keys)
    if check:
        new = read_places(spark, path, added)
        with settings(spark, **OWN_TASKS, **CLEAN):
            before, after = content_checksum(df.select(*COLUMNS)), content_checksum(new)
        if before != after:
            raise RuntimeError(f"staged rows differ from their source: {before} != {after}")
    unlisted = {p.folder for p in added} - set(folders)
    if unlisted:
        raise ValueError(f"rows outside the replaced partitions: {sorted(unlisted)}")
    return versions.commit(spark, root, old, added + arrived_meanwhile(spark, root, old, read))


def arrived_meanwhile(
    spark: SparkSession, root: str, old: list[versions.Place], read: set[str]
) -> list[versions.Place]:
    """Files that were appended to plain folders after these had been read: they stay."""
    plain = [p for p in old if not p.own_run]
    return [
        versions.Place(p.table, p.folder, f"{p.at}/{name}")
        for p, names in versions.files_of(spark, root, plain).items()
        for name in names
        if name not in read
    ]


def content_checksum(df: DataFrame) -> tuple[int, str]:
    """Row count and an order-free sum of row hashes."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")).alias("hashes"),
    ).first()
    return row["rows"], str(row["hashes"])
