"""Alignment of the tokens of two tokenizers by lockstep vectorised merging.

Both tokenizations of a text cover the same bytes. One NumPy state vector holds a pair of
token pointers for every document of a block; each step compares the byte offsets at which
the two tokens end, advances the pointers of the token that ends first (both, if they end
together: a cut, and a link of the two tokens) and drops what is finished from the vector.
Documents of more than ``LANE`` tokens have an entry for each ``LANE`` of them, so that the
number of steps does not grow with the longest text.

The links of a block are counted per id pair before anything is shuffled, so a pair sends
one row a block however common it is. Corpus-wide counts come back to the blocks the same way.

Defined cases
* Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
  tokens: zeros and an empty string.
* Special tokens' strings inside texts are plain text. Texts of any length are aligned whole.
* Rows that repeat a ``doc_id`` are aligned each by itself and all count; a null id is passed
  through. Other columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import Stored, group_count

#: Characters of text in a block (a longer text is one), tokens of an entry of the vector.
BLOCK_CHARS, LANE = 2_000_000, 512
#: Blocks that a task gives their counts.
TASK_BLOCKS = 8
#: Texts longer than this go to the slower of two equal implementations, which does not
#: backtrack over long runs of white space.
LONG_TEXT = 1_000_000
# Fixed value: the words of the byte-level vocabulary.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class ByteLevel:
    """A byte-level vocabulary file; each id stands for some bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path) as file:
            spec = json.load(file)
        # bytes that do not print are written as the letters from U+0100 on
        letters = {chr(b): b for b in _PLAIN}
        others = sorted(set(range(256)) - set(_PLAIN))
        letters |= {chr(0x100 + k): b for k, b in enumerate(others)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in word): own
            for word, own in spec["model"]["vocab"].items()
            if word not in special
        }
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for word, own in ranks.items():
            self.bytes_of[own] = word
        self._fast = tiktoken.Encoding(
            path, pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}
        )
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [
            self._fast.encode_ordinary(t)
            if len(t) <= LONG_TEXT
            else self._whole.encode(t, add_special_tokens=False).ids
            for t in (f" {t}" for t in texts)
        ]


class Pieces:
    """A model of pieces with byte fallback, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for own in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(own)
            byte = bytes([int(piece[3:5], 16)]) if self._model.is_byte(own) else None
            self.bytes_of.append(byte or piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []


class Links(NamedTuple):
    """Tokens of A and B that end together, by their places among all tokens of a block."""

    a: np.ndarray
    b: np.ndarray


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, lane: int = LANE) -> Links:
    """The links of documents whose tokens end at the ascending byte offsets ``a_end`` and
    ``b_end``, one document behind the other; ``a_from`` has the first A token of each."""
    if not len(a_end):
        return Links(np.empty(0, np.int64), np.empty(0, np.int64))
    stops = np.append(a_from[1:], len(a_end))
    lanes = -(-(stops - a_from) // lane)
    i = np.repeat(a_from, lanes)
    i += lane * (np.arange(len(i)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    stop = np.minimum(i + lane, np.repeat(stops, lanes))
    j = np.where(i > 0, np.searchsorted(b_end, a_end[i - 1], side="right"), 0)
    found_a, found_b = [], []
    while len(i):
        at_a, at_b = a_end[i], b_end[j]
        cut = at_a == at_b
        found_a.append(i[cut])
        found_b.append(j[cut])
        i, j = i + (at_a <= at_b), j + (at_b <= at_a)
        open_ = i < stop
        if not open_.all():
            i, j, stop = i[open_], j[open_], stop[open_]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a)
    return Links(a[order], b[order])


def written_groups(
    a_ids: np.ndarray, b_ids: np.ndarray, links: Links, ends: np.ndarray
) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each document; ``ends`` has the number of tokens, of A and B
    together, up to the end of each."""
    if not len(a_ids):
        return [b""] * len(ends)
    # a group's B tokens stand behind its A tokens
    group_a = np.searchsorted(links.a, np.arange(len(a_ids)))
    group_b = np.searchsorted(links.b, np.arange(len(b_ids)))
    place_a = np.arange(len(a_ids)) + np.append(0, links.b + 1)[group_a]
    place_b = np.arange(len(b_ids)) + links.a[group_b] + 1
    n = len(a_ids) + len(b_ids)
    ids, ending = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a_ids, b_ids
    ending[place_a[links.a]], ending[place_b[links.b]] = ord("|"), ord(";")
    # digits stand at the right of their row, nothing (0) before them
    top = int(ids.max())
    width = len(str(top))
    power = 10 ** np.arange(width - 1, -1, -1)
    shown = np.arange(top + 1)[:, None] // power
    digits = np.where(shown > 0, shown % 10 + ord("0"), 0).astype(np.uint8)
    digits[0, -1] = ord("0")
    table = np.concatenate([digits[ids], ending[:, None]], axis=1)
    flat = table[table > 0].tobytes()
    upto = np.append(0, np.cumsum((digits > 0).sum(axis=1)[ids] + 1))
    return [
        flat[upto[s] : max(upto[s], upto[e] - 1)]
        for s, e in zip(np.append(0, ends[:-1]), ends)
    ]


def _checked_tokens(encoder, texts: list[str]) -> list[list[int] | None]:
    """The ids of each text, None where their bytes are not a space and the text."""
    table = encoder.bytes_of
    return [
        ids if b"".join([table[i] for i in ids]) == b" " + text.encode() else None
        for ids, text in zip(encoder.encode(texts), texts)
    ]


class Block(NamedTuple):
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray  # the distinct id pairs, A * 2^32 + B
    counts: np.ndarray  # the links of each
    own: np.ndarray  # of each link its pair's place in `pairs`


def align_block(texts: list[str], first: ByteLevel, second: Pieces) -> Block:
    a_lists, b_lists = _checked_tokens(first, texts), _checked_tokens(second, texts)
    for k, (text, one, two) in enumerate(zip(texts, a_lists, b_lists)):
        if not text or one is None or two is None:
            a_lists[k] = b_lists[k] = []
    n_a, n_b = (np.array(list(map(len, lists)), np.int64) for lists in (a_lists, b_lists))
    a_ids, b_ids = (
        np.fromiter((i for ids in lists for i in ids), np.int64) for lists in (a_lists, b_lists)
    )
    sizes = [np.array(list(map(len, e.bytes_of)), np.int64) for e in (first, second)]
    a_upto, b_upto = np.cumsum(n_a), np.cumsum(n_b)
    links = lockstep(
        np.cumsum(sizes[0][a_ids]), np.cumsum(sizes[1][b_ids]), (a_upto - n_a)[n_a > 0]
    )
    per_doc = np.diff(np.searchsorted(links.a, np.append(0, a_upto)))
    keys = a_ids[links.a] << 32 | b_ids[links.b]
    pairs, own, counts = np.unique(keys, return_inverse=True, return_counts=True)
    groups = written_groups(a_ids, b_ids, links, a_upto + b_upto)
    return Block(n_a, n_b, per_doc, groups, pairs, counts, own.astype("<u4"))


def _slices(texts: list[str], most: int) -> Iterator[slice]:
    start = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > most:
            yield slice(start, k)
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_links long, groups string,"
    " groups_sha256 string, links binary, pairs array<long>, counts array<long>"
)


def align_blocks(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """A row per document with its links as places in its block's pairs, and a row per block
    with these pairs and their counts."""
    most = BLOCK_CHARS

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = None
        number = TaskContext.get().partitionId() << 33
        for part in parts:
            encoders = encoders or (ByteLevel(path_a), Pieces(path_b))
            texts = [t or "" for t in part["text"]]
            for rows in _slices(texts, most):
                found = align_block(texts[rows], *encoders)
                cuts = np.append(0, np.cumsum(found.n_links))
                out = pd.DataFrame({
                    "block": number,
                    "doc_id": part["doc_id"][rows].astype("Int64"),
                    "n_a": found.n_a, "n_b": found.n_b, "n_links": found.n_links,
                    "groups": [g.decode() for g in found.groups] if keep_groups else None,
                    "groups_sha256": [g and hashlib.sha256(g).hexdigest() or "" for g in found.groups],
                    "links": [found.own[s:e].tobytes() for s, e in zip(cuts, cuts[1:])],
                    "pairs": None, "counts": None,
                })
                own = dict.fromkeys(out.columns)
                own |= {"block": number, "pairs": found.pairs, "counts": found.counts}
                yield out
                if len(found.pairs):
                    yield pd.DataFrame([own]).astype(
                        {"doc_id": "Int64", "n_a": "Int64", "n_b": "Int64", "n_links": "Int64"}
                    )
                number += 1

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInPandas(of, ALIGNED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): the links of every id pair in the corpus, and whether no pair with the
    same B id has more."""
    own = blocks.where("pairs is not null").select(
        F.explode(F.arrays_zip("pairs", "counts")).alias("p")
    )
    counts = Stored(own.groupBy("p.pairs").agg(F.sum("p.counts").alias("n")), "pair-counts").df
    b = F.col("pairs").bitwiseAND(0xFFFFFFFF)
    # one row for each id of B's vocabulary at most
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    marked = counts.withColumn("b", b).join(F.broadcast(most), "b")
    return marked.select(F.col("pairs").alias("pair"), "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups, groups_sha256) for
    every document; ``groups`` is null unless ``keep_groups``."""
    blocks = Stored(align_blocks(docs, path_a, path_b, keep_groups), "aligned")
    places = blocks.df.where("pairs is not null").select(
        "block", F.posexplode("pairs").alias("place", "pair")
    )
    back = places.join(pair_counts(blocks.df), "pair").select("block", "place", "n", "best")
    rows = blocks.df.where("pairs is null").drop("pairs", "counts")
    tasks = group_count(docs, blocks.df.where("pairs is not null").count(), TASK_BLOCKS)
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups string, groups_sha256 string"
    )

    def summed(own: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values("place")
        n, best = pairs["n"].to_numpy(np.int64), pairs["best"].to_numpy(bool)
        links = [np.frombuffer(x, "<u4") for x in own["links"]]
        return own.assign(
            n_groups=own["n_links"],
            n_best=[int(best[x].sum()) for x in links],
            count_sum=[int(n[x].sum()) for x in links],
        )[[name.split()[0] for name in schema.split(", ")]]

    sides = [df.repartition(tasks, "block").groupBy("block") for df in (rows, back)]
    return sides[0].cogroup(sides[1]).applyInPandas(summed, schema)
