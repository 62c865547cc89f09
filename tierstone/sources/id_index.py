"""Which days hold a trade id: a small table beside a tier that is partitioned by day.

Its rows are (trade_id, trade_date), in buckets by a hash of the id. It stands in the same
versions as the tier, so both change in one commit, and the version also says which places of
the tier it covers: rows that another job added are indexed before the next look-up. An entry
whose trade has moved on costs a day read in vain, no more.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.sources import versions
from tierstone.sources.scans import read_places
from tierstone.sources.versions import Place, Version

BUCKETS = 64
#: Places of a bucket before they are written anew as one.
MOST_PLACES = 16
#: Entries that are written at once; their shuffle is about a gigabyte.
SLICE_ENTRIES = 16_000_000
SCHEMA = "trade_id string, trade_date date, bucket int"


def bucket_of(trade_id: Column) -> Column:
    return F.pmod(F.xxhash64(trade_id), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class IdIndex:
    """The index of ``table`` in the versions at ``root``."""

    root: str
    table: str

    @property
    def entries(self) -> str:
        return f"_ids_{self.table}"

    @property
    def covered(self) -> str:
        return f"_indexed_{self.table}"

    @property
    def path(self) -> str:
        return f"{self.root}/{self.entries}"

    def begin(self, spark: SparkSession) -> Version:
        return versions.begin(spark, self.root, {self.table: 1, self.entries: 1, self.covered: 1})

    def uncovered(self, now: Version) -> list[Place]:
        known = {(p.folder, p.at) for p in now.of(self.covered)}
        return [p for p in now.of(self.table) if (p.folder, p.at) not in known]

    def read(self, spark: SparkSession, now: Version, buckets: Iterable[int]) -> DataFrame:
        """The entries of some buckets."""
        places = now.of(self.entries, [f"bucket={b}" for b in buckets])
        return self._at(spark, places).select("trade_id", "trade_date")

    def _at(self, spark: SparkSession, places: list[Place]) -> DataFrame:
        if not places:
            return spark.createDataFrame([], SCHEMA)
        reader = spark.read.schema(SCHEMA).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{p.at}" for p in places])

    def of_places(self, spark: SparkSession, places: list[Place]) -> DataFrame:
        """The entries that rows at some places of the tier need."""
        rows = read_places(spark, versions.table_path(self.root, self.table), places)
        return entries_of(rows)

    def stage(
        self, spark: SparkSession, now: Version, entries: DataFrame, rows: int = 0
    ) -> tuple[list[Place], list[Place]]:
        """Write entries, about ``rows`` of them; returns the places added and, of buckets folded
        with them, removed. Many are written some buckets at a time, so that the disk of their
        shuffle is bounded."""
        per_bucket: dict[str, list[Place]] = {}
        for place in now.of(self.entries):
            per_bucket.setdefault(place.folder, []).append(place)
        full = [p for own in per_bucket.values() if len(own) >= MOST_PLACES for p in own]
        if full:
            folded = self._at(spark, full).select("trade_id", "trade_date")
            entries = entries.unionByName(folded).distinct()
        keyed = entries.withColumn("bucket", bucket_of(F.col("trade_id")))
        parts = min(BUCKETS, -(-rows // SLICE_ENTRIES) or 1)
        added: list[Place] = []
        for part in range(parts):
            run = versions.new_run()
            own = keyed.where(F.col("bucket") % parts == part) if parts > 1 else keyed
            spread = own.hint("rebalance", "bucket").sortWithinPartitions("bucket", "trade_id")
            writer = spread.write.option("compression", "zstd").partitionBy("bucket")
            writer.parquet(f"{self.path}/{run}")
            added += versions.run_places(spark, self.root, self.entries, run, 1)
        return added, full

    def cover(self, places: Iterable[Place]) -> list[Place]:
        """What the version says of places of the tier whose rows are indexed."""
        return [Place(self.covered, p.folder, p.at) for p in places]


def entries_of(rows: DataFrame) -> DataFrame:
    named = rows.where(F.col("trade_id").isNotNull())
    return named.select("trade_id", "trade_date").distinct()
