"""A corpus from raw documents: quality, line copies, near copies, leaks, packing.

Every stage takes all rows its predecessor kept. The first four return the columns of
their input; the last returns the packed pieces. A document without an id or a text is
judged like any other; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm import decontaminate, line_dedup, packing, quality, simhash
from tierstone.llm.common import Stored, fresh_name
from tierstone.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is more likely too low than good go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rating = fresh_name(docs, "rating")
    return quality.score(docs, model, rating).where(F.col(rating)["accepted"]).drop(rating)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; the text that is left and its length are updated."""
    lines = fresh_name(docs, "kept_lines")
    kept = line_dedup.drop_repeated_lines(docs, into=lines)
    text = F.col(lines)["text"]
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return kept.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a test item go."""
    leak = fresh_name(docs, "found_leak")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate.mark_contaminated(docs, benchmark, into=leak)
    return marked.where(F.col(leak)["n_hit"] == 0).drop(leak)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: The stages are not SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Stored(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return STAGES[-1][1](spark, docs, sf_dir)
