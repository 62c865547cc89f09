"""Approximate nearest neighbours by inner product with balanced posting lists.

Vectors get one more component that makes their lengths equal, so that the largest inner
product is the smallest distance. Centroids come from a k-means with prices on crowded
clusters, fitted on a bounded sample. Every vector stands in the list of its nearest
centroid; a boundary vector also in those that are nearly as near, unless a nearer list
lies in the same direction. A query walks a graph of the centroids, kept in memory, best
first, takes the nearest lists until they hold enough ids, and searches all lists within a
ratio of the distance to the last of them (mostly the very nearest): there is no limit on
their number. Lists are searched in tasks, long ones in slices.

Defined cases
* Vectors that are null, empty, zero or hold a null or a non-finite component take no part,
  nor do rows without an id, nor vectors whose length is not the commonest one.
* A repeated id counts once, with its best score, and never as its own neighbour.
* Of equal vectors only the smallest ids can be neighbours, one more than asked for; the
  others are left out before the search without loss. Ties go to the smaller id.
* Fewer candidates than asked for are all returned. Other columns are ignored. Empty tables
  give no rows.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import Stored, hash_sample, shuffle_partitions

NEIGHBOURS, QUERY_EVERY = 20, 20
#: Vectors the index is fitted on at most, lists at most, vectors of a list as wanted.
SAMPLE_ROWS, MOST_LISTS, LIST_ROWS = 20_000, 4096, 400
#: A vector joins lists within this ratio of its nearest centroid, COPIES of them at most.
BOUNDARY_RATIO, COPIES = 1.02, 2
SAMPLE_QUERIES, SAMPLE_RECALL = 300, 0.96
#: Links of a centroid to its nearest and to random others; centroids a walk opens at least.
GRAPH_DEGREE, FAR_LINKS, LEAST_OPENED = 24, 8, 32
#: Vectors of a slice of a list, and of a shard of slices that one task searches.
SLICE_ROWS, SHARD_ROWS, ASKED_TOGETHER = 4096, 16_384, 512
#: Vectors that are compared with all centroids at once.
CHUNK = 1024


@dataclass
class Index:
    centroids: np.ndarray  # of lengthened vectors
    graph: np.ndarray  # the nearest centroids of each
    far: float  # the largest squared length of a vector
    ratio: float = 1.0  # of a searched list's distance to that of the nearest

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.far - (x**2).sum(axis=1), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)

    def lists_of(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, lists): where each vector is stored."""
        for begin in range(0, len(x), CHUNK):
            dist = _distances(self.lengthened(x[begin : begin + CHUNK]), self.centroids)
            near = np.argsort(dist, axis=1, kind="stable")[:, :COPIES]
            own = np.take_along_axis(dist, near, axis=1)
            for k in range(near.shape[1]):
                at = np.flatnonzero(own[:, k] <= BOUNDARY_RATIO**2 * own[:, 0])
                yield begin + at, near[at, k]

    def calibrate(self, x: np.ndarray, k: int) -> None:
        """Take the ratio that reaches SAMPLE_RECALL of the k nearest within the sample."""
        ask = x[:SAMPLE_QUERIES]
        score = ask @ x.T
        np.fill_diagonal(score, -np.inf)
        near = np.argsort(-score, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
        to = _distances(np.pad(ask, ((0, 0), (0, 1))), self.centroids)
        needed = np.full((len(ask), len(x)), np.inf)
        for at, lists in self.lists_of(x):
            needed[:, at] = np.minimum(needed[:, at], to[:, lists])
        ratio = np.take_along_axis(needed, near, axis=1) / to.min(axis=1)[:, None].clip(1e-12)
        if ratio.size:
            self.ratio = float(np.sqrt(np.quantile(ratio, SAMPLE_RECALL))) + 1e-9

    def search(self, query: np.ndarray, held: dict[int, int], least: int) -> np.ndarray:
        """All lists within the ratio of the nearest ones that hold ``least`` ids together;
        ``held`` has the ids of a list, each id in one list only."""
        q = np.concatenate([query, [0.0]])
        d = lambda at: ((self.centroids[at] - q) ** 2).sum(axis=1)
        # entry points: some centroids spread over all, from the nearest of them on
        starts = np.arange(0, len(self.centroids), max(1, int(len(self.centroids) ** 0.5) // 4))
        seen = set(starts.tolist())
        heap = list(zip(d(starts).tolist(), starts.tolist()))
        heapq.heapify(heap)
        found: list[tuple[float, int]] = []  # by distance

        def enough() -> float:
            total = 0
            for dist, at in found:
                total += held.get(at, 0)
                if total >= least:
                    return dist
            return np.inf

        while heap:
            dist, at = heapq.heappop(heap)
            if len(found) >= LEAST_OPENED and dist > self.ratio**2 * enough():
                break
            insort(found, (dist, at))
            new = [n for n in self.graph[at].tolist() if n not in seen]
            seen.update(new)
            if new:
                for item in zip(d(np.array(new)).tolist(), new):
                    heapq.heappush(heap, item)
        reach = enough()
        if reach == np.inf:  # also the lists that the walk did not reach
            every = np.arange(len(self.centroids))
            found = sorted(zip(d(every).tolist(), every.tolist()))
            reach = enough()
        return np.array([at for dist, at in found if dist <= self.ratio**2 * reach])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1)[None, :], 0)


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means in which crowded clusters raise their price."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    price = np.zeros(k)
    for _ in range(rounds):
        own, least = np.empty(len(x), dtype=np.int64), 0.0
        for at in range(0, len(x), CHUNK):
            dist = _distances(x[at : at + CHUNK], centroids)
            own[at : at + CHUNK] = np.argmin(dist + price, axis=1)
            least += dist.min(axis=1).sum()
        scale = least / len(x) + 1e-12
        size = np.bincount(own, minlength=k)
        price += 0.05 * scale * (size * k / len(x) - 1)
        price -= price.min()
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        filled = size > 0
        centroids[filled] = sums[filled] / size[filled, None]
        if (~filled).any():
            centroids[~filled] = x[rng.choice(len(x), (~filled).sum())]
    return centroids


def build_index(vectors: DataFrame, n: int, far: float, k: int) -> Index | None:
    """Fitted on the ``SAMPLE_ROWS`` vectors whose ids hash lowest."""
    sample = hash_sample(vectors, ["vec_id"], SAMPLE_ROWS, n).select("e").toPandas()
    if not len(sample):
        return None
    index = Index(np.zeros((0, 0)), np.zeros((0, 0), int), far)
    plain = np.stack(sample["e"].to_list())
    lists = int(np.clip(n // LIST_ROWS, 1, MOST_LISTS))
    index.centroids = balanced_centroids(index.lengthened(plain), lists)
    dist = _distances(index.centroids, index.centroids)
    near = np.argsort(dist, axis=1, kind="stable")[:, 1 : GRAPH_DEGREE + 1]
    far = np.random.default_rng(5).integers(0, len(dist), (len(dist), FAR_LINKS))
    index.graph = np.concatenate([near, far], axis=1)
    index.calibrate(plain, k)
    return index


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, e): the rows that take part, components as doubles."""
    e = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).where(
        F.col("vec_id").isNotNull()
        & (F.size("e") > 0)
        & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("e", lambda v: v != 0)
    )
    sizes = rows.groupBy(F.size("e").alias("k")).count().orderBy(F.desc("count"), "k").first()
    return rows.where(F.size("e") == (sizes["k"] if sizes else 0))


def best_of(asked: pd.DataFrame, x: np.ndarray, ids: np.ndarray, place: dict, k: int) -> pd.DataFrame:
    """The k best vectors of each query among those of its lists; ``place`` has the rows of
    a list, which are in the order of their ids."""
    query, wanted = np.stack(asked["e"].to_list()), {}
    for row, lists in enumerate(asked["lists"]):
        for own in lists:
            wanted.setdefault(int(own), []).append(row)
    rows, at, score = [], [], []
    for own, who in wanted.items():
        if own in place:
            a, b = place[own]
            # einsum adds up every pair alike, so that equal vectors get equal scores
            s = np.einsum("qd,nd->qn", query[who], x[a:b])
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            rows.append(np.repeat(who, top.shape[1]))
            at.append(a + top.ravel())
            score.append(np.take_along_axis(s, top, axis=1).ravel())
    if not rows:
        return pd.DataFrame({"q": np.zeros(0, int), "vec_id": np.zeros(0, int), "score": np.zeros(0)})
    row, vec, s = np.concatenate(rows), ids[np.concatenate(at)], np.concatenate(score)
    order = np.lexsort((vec, -s, row))
    row, vec, s = row[order], vec[order], s[order]
    # copies of a vector in two lists have equal scores and stand side by side
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (vec[1:] != vec[:-1])])
    row, vec, s = row[new], vec[new], s[new]
    start = np.searchsorted(row, row)
    best = np.arange(len(row)) - start < k
    return pd.DataFrame({"q": asked["q"].to_numpy()[row[best]], "vec_id": vec[best], "score": s[best]})


def nearest(embeddings: DataFrame, is_query, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``is_query(vec_id)`` holds."""
    spark = embeddings.sparkSession
    rows = Stored(usable(embeddings), "vectors").df
    same = Window.partitionBy("e").orderBy("vec_id")
    distinct_ids = rows.distinct()
    kept = Stored(
        distinct_ids.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1),
        "kept-vectors",
    ).df
    length = F.aggregate("e", F.lit(0.0), lambda a, v: a + v * v)
    totals = kept.agg(F.count("*").alias("n"), F.max(length).alias("far")).first()
    index = build_index(kept, totals["n"], totals["far"] or 0.0, k)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)  # MOST_LISTS centroids at most

    def stored(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                for at, lists in shared.value.lists_of(np.stack(part["e"].to_list())):
                    yield part.iloc[at].assign(list=lists)[["list", "vec_id", "e"]]

    members = Stored(
        kept.select("vec_id", "e").mapInPandas(stored, "list long, vec_id long, e array<double>"),
        "posting-lists",
    ).df
    n_slices = F.ceil(F.count("*") / SLICE_ROWS).alias("slices")
    sizes = Stored(members.groupBy("list").agg(n_slices), "list-sizes").df
    slices = {r["list"]: r["slices"] for r in sizes.collect()}  # MOST_LISTS at most
    one_list = members.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count()
    held = {r["list"]: r["count"] for r in one_list.collect()}  # MOST_LISTS at most
    shards = max(1, -(-members.count() // SHARD_ROWS))
    own_slice = F.pmod(F.xxhash64("vec_id"), F.col("slices"))
    members = members.join(sizes, "list").withColumn(
        "shard", F.pmod(F.col("list") + own_slice, F.lit(shards))
    )

    def asked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for q, e in zip(part["q"], part["e"]):
                wanted: dict[int, list[int]] = {}
                for own in shared.value.search(e, held, k + 1).tolist():
                    for shard in {(own + n) % shards for n in range(slices.get(own, 0))}:
                        wanted.setdefault(shard, []).append(own)
                yield pd.DataFrame({
                    "shard": list(wanted), "q": q, "e": [e] * len(wanted), "lists": list(wanted.values()),
                })

    queries = Stored(distinct_ids.where(is_query(F.col("vec_id"))), "queries").df
    heads = Stored(queries.groupBy("e").agg(F.min("vec_id").alias("q")), "query-vectors").df
    probes = heads.repartition(shuffle_partitions(heads), "q").mapInPandas(
        asked, "shard long, q long, e array<double>, lists array<long>"
    )

    def scanned(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"q": np.zeros(0, int), "vec_id": np.zeros(0, int), "score": np.zeros(0)})]
        if len(left):
            left = left.sort_values(["list", "vec_id"])
            x, ids = np.stack(left["e"].to_list()), left["vec_id"].to_numpy()
            names, first = np.unique(left["list"].to_numpy(), return_index=True)
            place = dict(zip(names.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(ids)])))
            for at in range(0, len(right), ASKED_TOGETHER):
                out.append(best_of(right.iloc[at : at + ASKED_TOGETHER], x, ids, place, k + 1))
        return pd.concat(out)

    found = (
        members.select("shard", "list", "vec_id", "e").groupBy("shard")
        .cogroup(probes.groupBy("shard"))
        .applyInPandas(scanned, "q long, vec_id long, score double")
    )
    order = [F.desc("score"), F.col("vec_id")]
    best = found.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(*order)))
    best = Stored(best.where(F.col("r") <= k + 1).drop("r"), "found").df
    own = queries.withColumnRenamed("vec_id", "query_id").join(heads, "e").select("query_id", "q")
    ranked = Window.partitionBy("query_id").orderBy(*order)
    return (
        own.join(best, "q")
        .where("vec_id != query_id")
        # an id that stands in several rows has several query vectors
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
