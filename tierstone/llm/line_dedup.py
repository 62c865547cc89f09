"""Line deduplication with levelled sorted runs of line hashes.

A run is a Parquet table of line hashes, range-free but hash-partitioned and sorted,
with the number of documents that hold the line and the largest ``doc_id`` among
them. Every batch of documents becomes a run of level 0; when a level has ``fanout``
runs they are merged into one run of the next level. ``LineRuns.unseen`` anti-joins the
lines of a batch with the runs. A whole table (``drop_repeated_lines``) needs the merged
totals, as lines go by their count and largest id: all batches are added, and the lines are
inner-joined with those keys of the merged runs that are frequent enough.

Defined cases
* A document is a row. Rows that repeat a ``doc_id`` each count as a document, and the
  largest ``doc_id`` keeps its lines in all its rows. A line counts once in a row.
* Null or empty text is one empty line. An empty table gives an empty result.
* A null ``doc_id`` ranks below every other; a line found only without ids stays.
* Other columns are passed through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm.common import ASCII_SPACE, Stored, ascii_lower, fresh_name, row_key

#: Two 64-bit hashes name a line: 128 bits keep apart all lines of any corpus.
KEY = ["h1", "h2"]
BATCHES, FANOUT = 4, 2
MIN_CHARS, MIN_DOCS = 40, 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row, h1, h2): the long enough lines of each row, each once."""
    keys = F.filter(
        F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= min_chars
    )
    return docs.select(
        F.col("doc_id"),
        row_key(docs).alias("row"),
        F.explode(F.array_distinct(F.transform(keys, key_hash))).alias("key"),
    ).select("doc_id", "row", "key.h1", "key.h2")


class LineRuns:
    """The runs of one corpus, level by level; the driver holds their paths only."""

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, fanout: int = FANOUT):
        self.spark, self.min_chars, self.fanout = spark, min_chars, fanout
        self.levels: list[list[Stored]] = [[]]

    def _run(self, lines: DataFrame) -> Stored:
        return Stored(lines.sortWithinPartitions(*KEY), "line-run")

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, runs)
        return rows.groupBy(*KEY).agg(
            F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc")
        )

    def add(self, batch: DataFrame) -> None:
        """Add the run of a batch, and merge the levels that are full."""
        lines = hashed_lines(batch, self.min_chars)
        counted = lines.groupBy(*KEY).agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc")
        )
        self.levels[0].append(self._run(counted))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._run(self._merged([r.df for r in full])))
            for run in full:
                run.drop()
            level += 1

    @property
    def runs(self) -> list[Stored]:
        return [run for level in self.levels for run in level]

    def totals(self) -> DataFrame | None:
        """(h1, h2, n_docs, max_doc) over all runs; None before the first batch."""
        found = [run.df for run in self.runs]
        if len(found) < 2:
            return found[0] if found else None
        return self._merged(found)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """(doc_id, row, h1, h2): the lines of a batch that no run holds yet."""
        lines = hashed_lines(batch, self.min_chars)
        for run in self.runs:
            lines = lines.join(run.df.select(*KEY), KEY, "left_anti")
        return lines

    def drop(self) -> None:
        for run in self.runs:
            run.drop()
        self.levels = [[]]


def drop_repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    into: str = "lines",
) -> DataFrame:
    """``docs`` with a struct ``into``: n_lines, n_dropped and the text that is kept.

    A line with a key of at least ``min_chars`` code points that ``min_docs`` documents
    hold stays only in the largest ``doc_id`` among them.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    runs = LineRuns(spark, min_chars)
    for batch in range(batches):
        runs.add(source.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch))
    frequent = Stored(
        runs.totals().where(F.col("n_docs") >= min_docs).select(*KEY, "max_doc"), "line-frequent"
    )
    runs.drop()

    own, row, gone = (fresh_name(docs, n) for n in ("own_id", "own_row", "gone"))
    repeated = (
        hashed_lines(source, min_chars)
        .join(frequent.df, KEY)
        .where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
        .groupBy(F.col("row").alias(row), F.col("doc_id").alias(own))
        .agg(F.collect_set(F.struct(*KEY)).alias(gone))
    )
    lines = lines_of(F.col("text"))
    kept = F.filter(
        lines,
        lambda x: (F.length(line_key(x)) < min_chars)
        | ~F.array_contains(F.col(gone), key_hash(line_key(x))),
    )
    untouched = F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    thinned = F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )
    same = (row_key(docs) == F.col(row)) & docs["doc_id"].cast("long").eqNullSafe(F.col(own))
    joined = docs.join(repeated, same, "left")
    result = F.when(F.col(gone).isNull(), untouched).otherwise(thinned)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(into))
