"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Tokens are counted in tasks; pieces of full length fill a sequence alone. The other pieces
are dealt at random to blocks of bounded size. Every block is packed on several islands: a
genome is a list of bins, crossover injects the fullest bins of the other parent whole,
drops the bins they overlap and puts the displaced pieces back by best fit, with the small
mutation of emptying a badly filled bin. After every epoch the islands of a block exchange
their elites through Spark. At the end the badly filled bins of all blocks are packed again
in new blocks, round by round, until one block is left or the number of bins falls no more.

Defined cases
* Null and empty texts are one piece: the closing id alone.
* Rows that repeat a ``doc_id``, with or without the same text, are packed each by itself.
* A null ``doc_id`` is packed like any other. Other columns are ignored. Empty tables give
  an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import Stored

CAPACITY, END_ID = 2048, 0
#: Pieces of a block, islands of a block, genomes of an island, generations of an epoch.
BLOCK_PIECES, ISLANDS, GENOMES, GENERATIONS, EPOCHS = 12_000, 2, 3, 4, 2
#: Bins at least so full are final; the others are packed again.
FULL_ENOUGH = 1.0
#: Words whose ids a task keeps.
CACHED_WORDS = 1_000_000
_GAP = re.compile(r"[ \t\n\r]+")
_ODD_GAP = re.compile("[\x1c-\x1f]")  # white space for Python, not for the tokenizer
_POINTS = frozenset(".,;:!?")
#: Below it, letters have no other composed form, and but for one a one-letter lower case.
_LATIN_END, _TWO_LETTERS = "\u0250", "\u0130"
# Byte-level vocabularies write a byte as itself if it is a printable Latin-1 character, the
# others from U+0100 on in their order.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - _PLAIN))}


class Tokens(dict):
    """The ids of words as little-endian bytes. No token reaches over white space, nor from
    a run of letters into the point behind it, so texts are put together from their words'
    ids, and a word of plain letters is given to the vocabulary's merges directly."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        plain = bool(word) and max(word) < _LATIN_END and _TWO_LETTERS not in word
        if plain and word[-1] in _POINTS and word[:-1].isalpha():
            found = self[word[:-1]] + self[word[-1]]
        elif plain and word.isalpha():
            lower = word.lower()
            found = self._letters(word) if lower == word else self[lower]
        else:
            found = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = found
        return found

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return _packed([t.id for t in self.model.tokenize(word)])

    def document(self, text: str | None) -> bytes:
        text = text or ""
        words = _GAP.split(text) if _ODD_GAP.search(text) else text.split()
        found = itemgetter(*words)(self) if len(words) > 1 else [self[w] for w in words]
        return b"".join(found) + END_ID.to_bytes(4, "little")


@cache
def tokens_of(path: str) -> Tokens:
    """The words that a Python worker has met, in whichever of its tasks."""
    return Tokens(path)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece; ``slot`` numbers the pieces of all documents."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = tokens_of(tokenizer_path)
        slot = TaskContext.get().partitionId() << 33
        for part in parts:
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                ids = tokens.document(text)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own), slot))
                    slot += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"doc_id": "Int64"})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInPandas(cut, PIECES)


# --- one block -----------------------------------------------------------------------


def best_fit(bins: list[list[int]], free: list[int], items: np.ndarray, size: np.ndarray,
             capacity: int) -> None:
    """Put the items, largest first, into the bin they fill best, or into a new one."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    holes = np.zeros(capacity + 2, dtype=bool)
    for b, space in enumerate(free):
        room[space].append(b)
        holes[space] = True
    for item in items[np.argsort(-size[items], kind="stable")]:
        need = int(size[item])
        space = need + int(holes[need:].argmax())
        if not holes[space]:
            b, space = len(bins), capacity
            bins.append([])
            free.append(capacity)
        else:
            b = room[space].pop()
            holes[space] = bool(room[space])
        bins[b].append(int(item))
        free[b] = space - need
        room[free[b]].append(b)
        holes[free[b]] = True


def fitness(bins: list[list[int]], size: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then bins that are fuller or emptier than the mean."""
    fill = np.array([size[b].sum() for b in bins], dtype=float) / capacity
    return len(bins), -float((fill**2).sum())


def crossover(one: list[list[int]], two: list[list[int]], size: np.ndarray, capacity: int,
              rng: np.random.Generator) -> list[list[int]]:
    """``one`` with well-filled bins of ``two`` injected whole."""
    fill = np.array([size[b].sum() for b in two])
    best = np.argsort(-fill, kind="stable")[: max(1, len(two) // 2)]
    injected = [two[b] for b in rng.permutation(best)[: max(1, len(best) // 3)]]
    return _repaired(one, injected, size, capacity)


def mutation(one: list[list[int]], size: np.ndarray, capacity: int,
             rng: np.random.Generator) -> list[list[int]]:
    """``one`` with its emptiest bin and some others dissolved."""
    fill = np.array([size[b].sum() for b in one])
    gone = {int(fill.argmin()), *map(int, rng.integers(0, len(one), max(1, len(one) // 20)))}
    kept = [list(b) for k, b in enumerate(one) if k not in gone]
    loose = np.array([i for k in gone for i in one[k]], dtype=np.int64)
    free = [int(capacity - size[b].sum()) for b in kept]
    best_fit(kept, free, rng.permutation(loose), size, capacity)
    return kept


def _repaired(one, injected, size, capacity) -> list[list[int]]:
    taken = {i for b in injected for i in b}
    kept, loose = [], []
    for b in one:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            loose.extend(i for i in b if i not in taken)
    bins = [list(b) for b in injected] + kept
    free = [int(capacity - size[b].sum()) for b in bins]
    best_fit(bins, free, np.array(loose, dtype=np.int64), size, capacity)
    return bins


def _bins_of(genome: np.ndarray) -> list[list[int]]:
    order = np.argsort(genome, kind="stable")
    cuts = np.flatnonzero(np.diff(genome[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)]


def _genome_of(bins: list[list[int]], n: int) -> np.ndarray:
    genome = np.empty(n, dtype=np.int64)
    for k, b in enumerate(bins):
        genome[b] = k
    return genome


def evolve(size: np.ndarray, elites: list[np.ndarray], seed: int, capacity: int,
           genomes: int, generations: int) -> np.ndarray:
    """The best genome (bin of every piece) of an island after some generations."""
    rng = np.random.default_rng(seed)
    pool = [_bins_of(e) for e in elites]
    bound = -(-int(size.sum()) // capacity)
    for bins in pool:
        if len(bins) <= bound:
            return _genome_of(bins, len(size))
    for k in range(max(0, genomes - len(pool))):
        bins: list[list[int]] = []
        # the first starts as plain best-fit decreasing, the others from a disordered half
        some = rng.permutation(len(size))[: 0 if k == 0 else len(size) // 2]
        free: list[int] = []
        for item in some:
            if bins and free[-1] >= size[item]:
                bins[-1].append(int(item))
                free[-1] -= int(size[item])
            else:
                bins.append([int(item)])
                free.append(int(capacity - size[item]))
        best_fit(bins, free, np.setdiff1d(np.arange(len(size)), some), size, capacity)
        pool.append(bins)
        if len(bins) <= bound:  # nothing is left to gain
            return _genome_of(bins, len(size))
    ranked = sorted(((fitness(b, size, capacity), k, b) for k, b in enumerate(pool)))[:genomes]
    for generation in range(generations):
        if ranked[0][0][0] <= bound:
            break
        a, b = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
        child = crossover(ranked[min(a, b)][2], ranked[max(a, b)][2], size, capacity, rng)
        if generation % 3 == 2:
            child = mutation(child, size, capacity, rng)
        ranked = sorted([*ranked, (fitness(child, size, capacity), len(pool) + generation, child)])
        ranked = ranked[:genomes]
    return _genome_of(ranked[0][2], len(size))


# --- all blocks ----------------------------------------------------------------------


def _pack_blocks(spark_pieces: DataFrame, blocks: int, round_no: int, capacity: int) -> DataFrame:
    """(slot, length, block, bin): every piece of (slot, length) with its bin in its block."""
    block = F.pmod(F.xxhash64("slot", F.lit(round_no)), F.lit(blocks)).alias("block")
    source = spark_pieces.select("slot", "length", block)
    islands = source.select(
        "*", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island")
    )
    state = islands.select("block", "island", "slot", "length", F.array().cast("array<int>").alias("bins"))
    schema = "block long, island int, slot long, length long, bins array<int>"

    def epoch(number: int):
        def on_island(key, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("slot")
            size = part["length"].to_numpy()
            table = np.array(part["bins"].tolist(), dtype=np.int64).reshape(len(part), -1)
            seed = (int(key[0]) * ISLANDS + int(key[1])) * EPOCHS + number
            best = evolve(size, list(table.T), seed, capacity, GENOMES, GENERATIONS)
            return part.assign(bins=[[b] for b in best.tolist()])[list(part.columns)]

        return on_island

    for number in range(EPOCHS):
        state = state.groupBy("block", "island").applyInPandas(epoch(number), schema)
        if number + 1 < EPOCHS:
            # migration: every island of a block gets the elites of all its islands
            elites = state.groupBy("block", "slot", "length").agg(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("island", F.col("bins")[0].alias("bin")))),
                    lambda x: x["bin"],
                ).alias("bins")
            )
            state = elites.select(
                "block",
                F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"),
                "slot", "length", "bins",
            )
    state = Stored(
        state.select("block", "island", "slot", "length", F.col("bins")[0].alias("bin")), "islands"
    ).df
    fill = state.groupBy("block", "island", "bin").agg(F.sum("length").alias("fill"))
    merit = fill.groupBy("block", "island").agg(
        F.struct(
            F.count("*"), -F.sum(F.col("fill").cast("double") * F.col("fill")), F.col("island")
        ).alias("merit")
    )
    best = merit.groupBy("block").agg(F.min("merit.island").alias("any"), F.min("merit").alias("m"))
    winners = best.select("block", F.col("m.island").alias("island"))
    return state.join(winners, ["block", "island"], "left_semi").select(
        "slot", "length", "block", "bin"
    )


def pack(cut: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """(slot, sequence_id, offset) for pieces with (slot, length).

    A sequence is named by its smallest slot, and its pieces stand in the order of slots.
    """
    sized = cut.select("slot", "length")
    alone = sized.where(F.col("length") >= capacity)
    left = sized.where(F.col("length") < capacity)
    done: list[DataFrame] = []
    before, n_loose, round_no = None, 0, 0  # the pieces left as packed so far, in n_loose bins
    while blocks := -(-left.count() // block_pieces):
        named = F.struct(F.lit(round_no).alias("round"), "block", "bin")
        packed = Stored(
            _pack_blocks(left, blocks, round_no, capacity).select(
                "slot", "length", named.alias("bin")
            ),
            "packed",
        ).df
        fills = Stored(packed.groupBy("bin").agg(F.sum("length").alias("fill")), "fills").df
        if before is not None and fills.count() >= n_loose:
            done.append(before)
            break
        loose = fills.where(F.col("fill") < FULL_ENOUGH * capacity).select("bin")
        n_loose = loose.count()
        if blocks == 1 or not n_loose:
            done.append(packed)
            break
        done.append(packed.join(loose, "bin", "left_anti"))
        before = packed.join(loose, "bin", "left_semi")
        left, round_no = before.select("slot", "length"), round_no + 1
    placed = alone.select(
        "slot", F.col("slot").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    bin_ = Window.partitionBy("bin")  # of `capacity` pieces at most
    before = bin_.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    for part in done:
        placed = placed.unionByName(
            part.select(
                "slot",
                F.min("slot").over(bin_).alias("sequence_id"),
                F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("offset"),
            )
        )
    return placed


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document, with its sequence and its place there."""
    cut = Stored(pieces(docs, tokenizer_path, capacity), "pieces").df
    return cut.join(pack(cut, capacity), "slot").drop("slot")
