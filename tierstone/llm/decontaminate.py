"""Benchmark decontamination with a distributed positional inverted index.

The index holds the postings (term, document, position) of every corpus word that a
test item uses, written to the shared folder. A window of consecutive test words is
searched from its rarest terms: the postings of the rarest and of the second rarest
term, each moved back by the term's offset in the window, are intersected on document
and start. What is left is compared word by word with the text, so that a hash clash
cannot make a match. A proximity search asks only for all terms within some distance.

Defined cases
* Null and empty texts have no words; an item without words has no window and is never
  found. Items that share a window are all found by it; repeated items give equal
  windows; the same item_id in two rows counts once.
* A result belongs to a row of the documents: repeated ids are judged by their own text,
  and rows without an id like any other. An item without an id is counted in no list.
* Other columns are passed through, whatever their names. Empty tables give no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import Stored, ascii_lower, fresh_name, row_key

#: What stands between words: ASCII that is neither digit nor small letter.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), GAP), "")


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(w, phrase, n, items): every distinct window of the items' words."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.slice("words", F.col("at"), F.lit(window)).alias("part"))
        .groupBy(F.array_join("part", " ").alias("phrase"))
        .agg(F.max(F.size("part")).alias("n"), F.collect_set("item_id").alias("items"))
        .select(F.xxhash64("phrase").alias("w"), "phrase", "n", "items")
    )


class PositionalIndex:
    """Postings of the corpus for the terms of a set of test windows."""

    def __init__(self, docs: DataFrame, windows: DataFrame):
        self.windows = windows
        self.terms = windows.select(
            "w", F.posexplode(F.split("phrase", " ")).alias("at", "term")
        ).select("w", "at", F.xxhash64("term").alias("t"))
        tokens = docs.select(
            row_key(docs).alias("d"), F.posexplode(words_of(F.col("text")))
        ).select("d", F.col("pos").alias("p"), F.xxhash64("col").alias("t"))
        self._postings = Stored(
            tokens.join(self.terms.select("t").distinct(), "t").select("t", "d", "p"), "postings"
        )

    @property
    def postings(self) -> DataFrame:
        return self._postings.df

    def drop(self) -> None:
        self._postings.drop()

    def rarest(self) -> DataFrame:
        """(w, rare): each window's terms from the rarest on; windows with a term
        that the corpus lacks are left out."""
        counts = Stored(self.postings.groupBy("t").agg(F.count("*").alias("freq")), "term-counts")
        return (
            self.terms.join(counts.df, "t", "left")
            .groupBy("w")
            .agg(
                F.array_sort(F.collect_list(F.struct("freq", "at", "t"))).alias("rare"),
                F.count_if(F.col("freq").isNull()).alias("lacking"),
            )
            .where(F.col("lacking") == 0)
            .select("w", "rare")
        )

    def _starts(self, rare: DataFrame, rank: int) -> DataFrame:
        """(w, d, s): where a window would start by its term of that rank."""
        anchors = rare.where(F.size("rare") > rank).select(
            "w", F.col("rare")[rank]["t"].alias("t"), F.col("rare")[rank]["at"].alias("at")
        )
        return (
            self.postings.join(anchors, "t")
            .select("w", "d", (F.col("p") - F.col("at")).alias("s"))
            .where(F.col("s") >= 0)
        )

    def candidates(self) -> DataFrame:
        """(w, d, s) where the two rarest terms of a window stand at their offsets."""
        rare = Stored(self.rarest(), "window-terms").df
        first, second = self._starts(rare, 0), self._starts(rare, 1)
        single = rare.where(F.size("rare") == 1).select("w")
        return first.join(second, ["w", "d", "s"], "left_semi").unionByName(
            first.join(single, "w", "left_semi")
        )

    def near(self, within: int) -> DataFrame:
        """(w, d, s): documents (by their row key) in which all terms of a window occur within ``within``
        words, and the smallest start of such a stretch at an occurrence of its rarest
        term. Later terms are looked up only around the starts that are left."""
        rare = Stored(self.rarest(), "window-terms").df
        terms = rare.select("w", F.posexplode(F.array_distinct(F.col("rare.t"))).alias("rank", "t"))
        most = terms.agg(F.max("rank")).first()[0]
        # a stretch of `within` words that holds position p starts at p-within+1 .. p
        left = self.postings.join(terms.where("rank = 0"), "t").select(
            "w", "d", F.explode(F.sequence(F.col("p") - (within - 1), F.col("p"))).alias("s")
        )
        left = left.distinct()
        for rank in range(1, (most or 0) + 1):
            hits = self.postings.join(terms.where(F.col("rank") == rank), "t").select(
                "w", "d", F.explode(F.sequence(F.col("p") - (within - 1), F.col("p"))).alias("s")
            )
            has = terms.where(F.col("rank") == rank).select("w")
            left = left.join(hits, ["w", "d", "s"], "left_semi").unionByName(
                left.join(has, "w", "left_anti")
            )
        return left.groupBy("w", "d").agg(F.min("s").alias("s"))


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, into: str = "leak"
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, items and spans.

    spans are the word ranges [start, stop) of the occurrences of test windows, n_hit
    the words inside any of them, items the sorted ids of the items they come from.
    """
    windows = Stored(test_windows(benchmark, window), "windows").df
    index = PositionalIndex(docs, windows)
    own, found = fresh_name(docs, "own_key"), fresh_name(docs, "found")
    per_doc = (
        index.candidates()
        .join(windows, "w")
        .groupBy(F.col("d").alias(own))
        .agg(F.collect_list(F.struct("s", "n", "phrase", "items")).alias(found))
    )
    words = fresh_name(docs, "words")
    joined = docs.join(per_doc, row_key(docs) == F.col(own), "left").withColumn(
        words, words_of(F.col("text"))
    )
    here = F.array_sort(
        F.filter(
            F.coalesce(F.col(found), F.array()),
            lambda c: F.array_join(F.slice(F.col(words), c["s"] + 1, c["n"]), " ") == c["phrase"],
        )
    )
    matched = joined.withColumn(found, F.when(F.col(found).isNotNull(), here))
    spans = F.transform(
        F.col(found),
        lambda c: F.struct(
            c["s"].cast("long").alias("start"), (c["s"] + c["n"]).cast("long").alias("stop")
        ),
    )
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        spans,
        zero,
        lambda a, x: F.struct(
            (
                a["hit"]
                + F.greatest(F.lit(0).cast("long"), x["stop"] - F.greatest(x["start"], a["end"]))
            ).alias("hit"),
            F.greatest(a["end"], x["stop"]).alias("end"),
        ),
        lambda a: a["hit"],
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(F.col(found), lambda c: c["items"]))))
    nothing = F.array().cast("array<string>")
    result = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(items, nothing).alias("items"),
        F.coalesce(spans, F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"),
    )
    return matched.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(into))
