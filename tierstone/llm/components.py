"""Connected components of a distributed edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import Stored


def _downward(edges: DataFrame) -> DataFrame:
    """Every edge once, from its larger to its smaller end."""
    return (
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _hung(edges: DataFrame, keep) -> DataFrame:
    """``edges`` (u, v) that hold ``keep``, with the least neighbour m of u. The minima are
    written first, so that the join of a hub with its many edges can be split."""
    least = Stored(edges.groupBy("u").agg(F.min("v").alias("m")), "star-minima")
    return edges.where(keep).join(least.df, "u")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _hung(both, F.col("v") > F.col("u"))
    large = Stored(
        large.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "star"
    ).df
    small = _hung(large, F.lit(True))
    return _downward(
        small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                       F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v")
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node reachable."""
    state = Stored(_downward(edges), "edges")
    mark = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
    before = state.df.agg(mark).first()[0]
    while before["n"]:
        after = Stored(_round(state.df), "edges")
        now = after.df.agg(mark).first()[0]
        state.drop()
        state = after
        if now == before:
            break
        before = now
    stars = state.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
