"""SimHash near-duplicates, compared on vertical bit planes.

Two 64-bit fingerprints within the radius r agree on at least two of r + 2 bit blocks, so
every pair meets in a bucket of one pair of blocks. The fingerprints of a bucket are laid
out as 64 bit planes; a shift of the planes by d lanes compares every fingerprint with the
d-th next one, 64 pairs a word. The differing planes are added in carry-save counters that
start so that the count r + 1 overflows; a block of lanes is abandoned when all its lanes
have overflowed. From a bucket come the edges of a spanning forest only, never all pairs.
Buckets beyond ``TILE`` fingerprints are dealt as tiles of two parts to several tasks.

Defined cases
* Null and text without words: fingerprint zero, linked like any other.
* Equal fingerprints are compared once. Rows that repeat a ``doc_id`` are each fingerprinted;
  their components are named by the smallest id; a component with no id at all has none.
* Other columns are passed through by ``keep_representatives``. Empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.llm.common import Stored, fresh_name, group_count
from tierstone.llm.components import connected_components

BITS, SEED = 64, 42
SHINGLE, RADIUS = 4, 4
TILE = 8192
#: Fingerprints in a task's group, and words of 64 lanes compared at once.
GROUP_ROWS, BLOCK_WORDS = 250_000, 2048


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [end - 1 for end in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    major = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(major.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, into: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long."""

    @F.pandas_udf(T.LongType())
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            found = np.array([text_fingerprint(t, shingle) for t in part], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return docs.withColumn(into, of(F.col("text")))


def block_masks(radius: int) -> list[int]:
    """The bits of every two of radius + 2 blocks, as signed 64-bit masks."""
    edges = np.linspace(0, BITS, radius + 3).round().astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close_lanes(planes: np.ndarray, lanes: int, d: int, radius: int, valid: np.ndarray) -> np.ndarray:
    """Lanes i with a true ``valid[i]`` whose fingerprint differs from that of lane i + d
    in at most ``radius`` bits. planes: 64 x words, bit i % 64 of word i // 64 is lane i."""
    n_words = -(-lanes // 64)
    bits = np.zeros(n_words * 64, dtype=np.uint8)
    bits[:lanes] = valid[:lanes]
    wanted = np.packbits(bits, bitorder="little").view(np.uint64)
    skip, shift = divmod(d, 64)
    n_counters = (radius + 1).bit_length()
    bias = (1 << n_counters) - 1 - radius
    near = np.zeros(n_words, dtype=np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for at in range(0, n_words, BLOCK_WORDS):
        end = min(at + BLOCK_WORDS, n_words)
        over = ~wanted[at:end]
        counters = [np.full(end - at, full if bias >> k & 1 else 0, np.uint64) for k in range(n_counters)]
        for bit in range(0, BITS, 2):
            x, y = (_differ(planes[b], at, end, skip, shift) for b in (bit, bit + 1))
            # a carry-save step takes two planes, its carry ripples through the rest
            half = counters[0] ^ x
            carry = (counters[0] & x) | (half & y)
            counters[0] = half ^ y
            for k in range(1, n_counters):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if bit % 8 == 6 and (over == full).all():
                break
        near[at:end] = ~over
    return np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[:lanes])


def _differ(plane: np.ndarray, at: int, end: int, skip: int, shift: int) -> np.ndarray:
    other = plane[at + skip : end + skip] >> np.uint64(shift)
    if shift:
        other = other | (plane[at + skip + 1 : end + skip + 1] << np.uint64(64 - shift))
    return plane[at:end] ^ other


def bucket_forest(fp: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links inside each bucket."""
    _, inverse, sizes = np.unique(bucket, return_inverse=True, return_counts=True)
    order = np.lexsort((fp, inverse, -sizes[inverse]))
    fp, inverse = fp[order], inverse[order]
    size = sizes[inverse]  # from the largest bucket down
    n, most = len(fp), int(size[0]) if len(fp) else 0
    spare = n + most + 128
    bits = np.zeros((BITS, -(-spare // 64) * 64), dtype=np.uint8)
    raw = fp.astype("<u8").view(np.uint8).reshape(-1, 8)
    bits[:, :n] = np.unpackbits(raw, axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    root = np.arange(n)
    for d in range(1, most):
        lanes = int(np.searchsorted(-size, -d, side="left"))  # of buckets larger than d
        lanes = min(lanes, n - d)
        if lanes <= 0:
            break
        same = inverse[:lanes] == inverse[d : lanes + d]
        left = close_lanes(planes, lanes, d, radius, same)
        join_roots(root, left, left + d)
    linked = np.flatnonzero(root != np.arange(n))
    return fp[linked], fp[root[linked]]


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite a[i] and b[i]; ``root`` stays flat and points to the least member."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(flat := root[root], root):
            root[:] = flat


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): edges that connect the distinct fingerprints ``fp`` within the radius."""
    masks = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for t, m in enumerate(block_masks(radius))
    ])
    rows = prints.select("fp", F.explode(masks).alias("b")).select("fp", "b.t", "b.key")
    sizes = Stored(
        rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes"
    )
    total = sizes.df.agg(F.sum("n")).first()[0] or 0
    parts = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        rows.join(sizes.df, ["t", "key"])
        .withColumn("parts", parts)
        .select("t", "key", "fp", "parts", own.alias("own"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(
            "fp",
            F.xxhash64(
                "t", "key", F.least("own", "other"), F.greatest("own", "other")
            ).alias("bucket"),
        )
    )
    groups = group_count(prints, total, GROUP_ROWS)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        u, v = bucket_forest(
            rows["fp"].to_numpy().view(np.uint64), rows["bucket"].to_numpy(), radius
        )
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)}).drop_duplicates()

    return (
        dealt.groupBy(F.pmod("bucket", F.lit(groups)).alias("g"))
        .applyInPandas(compare, "u long, v long")
        .distinct()
    )


def _grouped(prints: Stored, radius: int) -> DataFrame:
    """(fp, component_id, keeper): for every fingerprint its component's smallest doc_id
    and the row that stands for the component."""
    last = F.lit(2**63 - 1)
    first = F.min(F.struct(F.coalesce("doc_id", last).alias("id"), "row", "doc_id"))
    by_print = Stored(prints.df.groupBy("fp").agg(first.alias("first")), "prints")
    roots = connected_components(fingerprint_links(by_print.df.select("fp"), radius))
    rooted = Stored(
        by_print.df.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "first"
        ),
        "rooted",
    )
    heads = Stored(rooted.df.groupBy("root").agg(F.min("first").alias("head")), "heads")
    return rooted.df.join(heads.df, "root").select(
        "fp", F.col("head.doc_id").alias("component_id"), F.col("head.row").alias("keeper")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = Stored(
        fingerprints(source, shingle)
        .drop("text")
        .withColumn("row", F.monotonically_increasing_id()),
        "fingerprints",
    )
    groups = Stored(_grouped(prints, radius), "groups")
    return prints.df.join(groups.df, "fp").select("doc_id", "fp", "component_id")


def keep_representatives(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id."""
    fp, row = fresh_name(docs, "fp_"), fresh_name(docs, "row_")
    whole = Stored(
        fingerprints(docs, shingle, fp).withColumn(row, F.monotonically_increasing_id()), "printed"
    )
    prints = Stored(
        whole.df.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col(fp).alias("fp"),
            F.col(row).alias("row"),
        ),
        "fingerprints",
    )
    keepers = _grouped(prints, radius).select(F.col("keeper").alias(row)).distinct()
    return whole.df.join(keepers, row, "left_semi").drop(fp, row)
