"""Secrets in texts: strict patterns, and a battery of randomness tests for other strings.

Candidates are runs of at least ``LEAST`` characters of the base-64 alphabets outside the
strict matches. Each is read in the smallest encoding that has all its characters, and three
tests ask whether its symbols look drawn uniformly: chi-squared over equal parts of the
alphabet, runs above and below its middle, and serial correlation. Fisher's method puts the
three p-values together into one, which is high for random strings.

Short ordinary strings can look random too. How often is read off strings without a secret:
for every encoding and length class, chains with the corpus's own pair frequencies of
neighbouring characters (all texts, shorter runs only) go through the same battery. The share
of chains that look at least as random is a candidate's p-value for being ordinary, and the
Benjamini-Hochberg rule, applied within each length class to all candidates of the corpus,
holds the share of ordinary strings among those added at ``FALSE_SHARE``. A string that the
battery itself rejects as random (below ``CONSISTENT``) is never added, however odd it is.

Defined cases
* Null and empty texts have no spans. Whole texts are searched, of any length.
* Rows that repeat a doc_id are each searched and all count; a null doc_id is passed through.
* Strict matches always stay, those of different kinds may overlap, and no added span overlaps
  one. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import Stored

KINDS = ("assign", "access", "hex", "random")
#: Characters of a candidate at least, starts of the length classes, share of false additions.
LEAST, CLASSES, FALSE_SHARE = 20, (20, 24, 32, 48, 64, 128), 0.01
#: Random strings that the battery may reject.
CONSISTENT = 0.01
#: Chains of each encoding and length class.
CHAINS, SEED = 4000, 1
# The strict patterns and the encodings, smallest first.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
_UP, _LOW, _NUM = string.ascii_uppercase, string.ascii_lowercase, string.digits
ENCODINGS = [
    _NUM, _NUM + "abcdef", _NUM + "ABCDEF", _UP + "234567", _LOW + _NUM, _UP + _NUM,
    _UP + _LOW + _NUM, _UP + _LOW + _NUM + "+/", _UP + _LOW + _NUM + "-_", _UP + _LOW + _NUM + "+/-_",
]
_SYMBOLS = ENCODINGS[-1]
_SETS = [frozenset(e) for e in ENCODINGS]
_PLACES = [{c: k for k, c in enumerate(e)} for e in ENCODINGS]


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """The base matches, by start and then kind. A match is the whole pattern's."""
    spans = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, strict: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Long runs that no strict match overlaps."""
    taken = sorted((a, b) for _, a, b in strict)
    out, t, reach = [], 0, 0
    for m in _RUN.finditer(text):
        a, b = m.span()
        while t < len(taken) and taken[t][0] < b:
            reach = max(reach, taken[t][1])
            t += 1
        if reach <= a:
            out.append((a, b))
    return out


def encoding_of(run: str) -> tuple[int, np.ndarray] | None:
    """The smallest encoding with all characters of a run, and their places in it; the ``=``
    behind it is padding."""
    body = run.rstrip("=")
    if len(body) < LEAST:
        return None
    own = set(body)
    for k, symbols in enumerate(_SETS):
        if own <= symbols:
            return k, np.array([_PLACES[k][c] for c in body])
    return None


def _two_sided(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(abs(x) / math.sqrt(2)) for x in z])


def battery(places: np.ndarray, size: int) -> np.ndarray:
    """(n, 3): p-values of uniformity, runs and serial correlation of n strings of one length
    (rows) over an alphabet of ``size`` symbols."""
    n, length = places.shape
    # uniformity, over as many equal parts of the alphabet as the length bears
    parts = int(min(size, max(2, length // 4)))
    part = np.arange(size) * parts // size
    expected = length * np.bincount(part, minlength=parts) / size
    seen = np.zeros((n, parts))
    np.add.at(seen, (np.arange(n)[:, None], part[places]), 1)
    chi, free = ((seen - expected) ** 2 / expected).sum(axis=1), parts - 1
    z = (np.cbrt(chi / free) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    uniform = np.array([math.erfc(x / math.sqrt(2)) / 2 for x in z])
    # runs above and below the middle
    high = places >= size / 2
    q = float((np.arange(size) >= size / 2).mean())
    pq = q * (1 - q)
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    spread = math.sqrt(4 * length * pq * (1 - 3 * pq) - 2 * pq * (3 - 10 * pq))
    # neighbours
    x = places - (size - 1) / 2
    close = (x[:, 1:] * x[:, :-1]).sum(axis=1) / ((size * size - 1) / 12) / math.sqrt(length - 1)
    both = _two_sided((runs - (1 + 2 * (length - 1) * pq)) / spread), _two_sided(close)
    return np.stack([uniform, *both], axis=1)


def randomness(places: np.ndarray, size: int) -> np.ndarray:
    """The p-values together: high for random strings, about nothing for others."""
    half = -np.log(np.maximum(battery(places, size), 1e-300)).sum(axis=1)
    return np.exp(-half) * (1 + half + half * half / 2)


def length_class(length: int) -> int:
    return int(np.searchsorted(CLASSES, length, side="right")) - 1


# --- what ordinary strings look like --------------------------------------------------


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often each pair of symbols stands together in runs shorter than candidates."""
    place = np.full(256, -1, np.int64)
    place[np.frombuffer(_SYMBOLS.encode(), np.uint8)] = np.arange(len(_SYMBOLS))
    inside = place >= 0
    inside[ord("=")] = True
    n = len(_SYMBOLS)

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n * n, np.int64)
        for part in parts:
            for text in part["text"].dropna():
                raw = np.frombuffer(text.encode(), np.uint8)
                if len(raw) < 2:
                    continue
                edges = np.flatnonzero(np.diff(inside[raw])) + 1
                sizes = np.diff(np.concatenate([[0], edges, [len(raw)]]))
                short = np.repeat(sizes < LEAST, sizes)
                own = place[raw]
                kept = (own[1:] >= 0) & (own[:-1] >= 0) & short[1:] & short[:-1]
                total += np.bincount(own[:-1][kept] * n + own[1:][kept], minlength=n * n)
        yield pd.DataFrame({"pair": np.arange(n * n), "n": total})

    counted = docs.select("text").mapInPandas(of, "pair int, n long")
    summed = counted.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # n * n rows at most
    out = np.zeros(n * n)
    out[summed["pair"]] = summed["n"]
    return out.reshape(n, n)


def ordinary(pairs: np.ndarray, chains: int = CHAINS) -> np.ndarray:
    """(encoding, length class, chains): the sorted randomness of strings with these pairs, of
    the shortest length of a class, where the battery tells least. Words in capitals count as
    ordinary too: encodings without small letters have the pairs of both cases."""
    rng = np.random.default_rng(SEED)
    where = {c: k for k, c in enumerate(_SYMBOLS)}
    capital = np.array([where[c.upper()] for c in _SYMBOLS])
    capitals = np.zeros_like(pairs)
    np.add.at(capitals, (capital[:, None], capital[None, :]), pairs)
    out = np.empty((len(ENCODINGS), len(CLASSES), chains))
    for e, symbols in enumerate(ENCODINGS):
        own = [where[c] for c in symbols]
        source = capitals if symbols == symbols.upper() else pairs
        table = source[np.ix_(own, own)] + 0.01
        start = table.sum(axis=1).cumsum() / table.sum()
        steps = (table.cumsum(axis=1) / table.sum(axis=1, keepdims=True))[:, :-1]
        places = np.empty((chains, CLASSES[-1]), np.int64)
        places[:, 0] = np.searchsorted(start[:-1], rng.random(chains))
        for k in range(1, CLASSES[-1]):
            places[:, k] = (steps[places[:, k - 1]] < rng.random(chains)[:, None]).sum(axis=1)
        for c, length in enumerate(CLASSES):
            out[e, c] = np.sort(randomness(places[:, :length], len(symbols)))
    return out


def accepted_ranks(counts: dict[tuple[int, int], int], chains: int = CHAINS,
                   share: float = FALSE_SHARE) -> list[int]:
    """For each length class the largest rank that is added, -1 for none.

    ``counts`` has the candidates of each class and rank; a rank is the number of chains that
    look at least as random, so (rank + 1) / (chains + 1) is the p-value.
    """
    out = [-1] * len(CLASSES)
    for c in range(len(CLASSES)):
        own = sorted((rank, n) for (k, rank), n in counts.items() if k == c)
        total, upto = sum(n for _, n in own), 0
        for rank, n in own:
            upto += n
            if rank < chains and (rank + 1) / (chains + 1) <= share * upto / total:
                out[c] = rank
    return out


# --- the corpus -----------------------------------------------------------------------

SPANS = "array<struct<a:int,kind:int,b:int>>"
FOUND = f"base {SPANS}, loose array<struct<a:int,kind:int,b:int,class:int,rank:int>>"


def search(docs: DataFrame, null: np.ndarray) -> DataFrame:
    """(doc_id, base, loose): strict matches, and candidates with length class and rank."""
    chains = null.shape[2]

    @F.pandas_udf(FOUND)
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            base, loose = [], []
            for text in part:
                text = text or ""
                strict = strict_spans(text)
                base.append([{"a": a, "kind": KINDS.index(k), "b": b} for k, a, b in strict])
                rows = []
                for a, b in candidates(text, strict):
                    if not (read := encoding_of(text[a:b])):
                        continue
                    encoding, places = read
                    sure = randomness(places[None], len(ENCODINGS[encoding]))[0]
                    c = length_class(len(places))
                    rank = chains
                    if sure >= CONSISTENT:
                        rank -= int(np.searchsorted(null[encoding, c], sure))
                    rows.append({"a": a, "kind": 3, "b": b, "class": c, "rank": rank})
                loose.append(rows)
            yield pd.DataFrame({"base": base, "loose": loose})

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), of(F.col("text")).alias("f")
    ).select("doc_id", "f.*")


def _of_kind(spans: str, kind: int) -> Column:
    # a second parameter of the lambda would be the span's place in the array
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["a"], s["b"])
        ),
        ",",
    )


def find_secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_added, base, spans); the first three counts are
    those of the strict matches, ``base`` has these and ``spans`` the added ones as well."""
    null = ordinary(pair_counts(docs))
    found = Stored(search(docs, null), "secret-candidates").df
    ranks = found.select(F.explode("loose").alias("x")).groupBy("x.class", "x.rank").count()
    limits = accepted_ranks(
        {(r["class"], r["rank"]): r["count"] for r in ranks.collect()},  # classes x chains at most
        null.shape[2], share,
    )
    limit = F.array(*map(F.lit, limits))
    added = F.transform(
        F.filter("loose", lambda x: x["rank"] <= limit[x["class"]]),
        lambda x: F.struct(x["a"].alias("a"), x["kind"].alias("kind"), x["b"].alias("b")),
    )
    counts = [_of_kind("base", k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, "base", added.alias("added")).select(
        "doc_id",
        *(f"n_{name}" for name in KINDS[:3]),
        F.size("added").cast("long").alias("n_added"),
        _joined(F.col("base")).alias("base"),
        _joined(F.concat("base", "added")).alias("spans"),
    )
