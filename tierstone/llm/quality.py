"""Ordinal cumulative-link regression on graded ratings of documents.

One weight vector over hashed text features gives a document's score f; ordered thresholds
t_1 < t_2 < ... cut it into grades, P(grade >= k) = sigmoid(f - t_k). The model is fitted on
a bounded sample of the labelled documents, drawn by a hash of their ids, and scores every
document from its whole text.

Defined cases
* Null text and text without words: all features are zero, so the score is zero.
* Labels without a document, with a null or out of range are not used. A table without
  usable labels, or with one grade only, gives a model that accepts every document.
* Several labels of one doc_id are all used, as are rows that repeat a doc_id.
* Other columns are passed through, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.llm.common import hash_sample

#: Labelled documents that the model is fitted on, at most.
SAMPLE_ROWS = 4000
HASH_BITS = 18
#: Stems are the first so many bytes of a longer word. The vector of
#: words is SCALE long, shares are multiplied by it.
STEMS, SCALE = (4, 5, 6), 8.0
#: A feature needs so many documents of the sample.
MIN_DOCS = 4
#: Grades: 0 toxic, 1 of low quality, 2 good.
GRADES = 3
ACCEPT_FROM, ACCEPT_TAIL = 2, 0.5
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = np.zeros(256, dtype=bool)  # ASCII letters and digits, and all bytes beyond ASCII
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[[ord(c) for c in ".,;:?!'\")"]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNSTEP = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64))])


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class TextFeatures:
    """Hashed features of a text: the words and word stems it has, and which shares of
    its tokens have which ending, end in a symbol, repeat the word before or shout."""

    def __init__(self, bits: int = HASH_BITS):
        self.bits = bits
        self._up = self._down = np.zeros(0, np.uint64)

    def _sized(self, n: int) -> None:
        if len(self._up) <= n:
            size = max(n + 1, 1 << 17)
            self._up, self._down = _powers(_STEP, size), _powers(_UNSTEP, size)

    def _hashes(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((sums[stop] - sums[start]) * self._down[start])

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        start, stop = _runs(~_SPACE[raw])
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0)
        self._sized(len(raw))
        upper = (raw >= 65) & (raw <= 90)
        lower = (raw + 32 * upper).astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(lower * self._up[: len(raw)])])
        first, last = _runs(_WORD[raw])
        words = self._hashes(sums, first, last)
        longer = [first[last - first > n] for n in STEMS]
        stems = [self._hashes(sums, at, at + n) for n, at in zip(STEMS, longer)]
        loud = (np.add.reduceat(upper, start) * 2 > stop - start).astype(np.uint64)
        ends = self._hashes(sums, np.maximum(start, stop - 2), stop) ^ (loud + np.uint64(7))
        odd = ~_WORD[raw[stop - 1]] & ~_POINT[raw[stop - 1]]
        n_same = (words[1:] == words[:-1]).sum()
        shift = np.uint64(64 - self.bits)
        found, counts = np.unique(_mixed(ends) >> shift, return_counts=True)
        slots, times = np.unique(np.concatenate([words, *stems]) >> shift, return_counts=True)
        value = np.log1p(times)
        value *= SCALE / max(np.sqrt((value**2).sum()), 1.0)
        shares = np.concatenate([counts, [odd.sum(), n_same, loud.sum()]]) / len(start)
        slots = np.concatenate([slots, found, np.arange(3, dtype=np.uint64)])
        return slots.astype(np.int64), np.concatenate([value, SCALE * shares])


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... as columns."""
        return 1 / (1 + np.exp(-(np.asarray(score)[:, None] - self.thresholds[None, :])))


def fit_ordinal(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, size: int,
    n_grades: int = GRADES, min_docs: int = MIN_DOCS, ridge: float = 3e-4, steps: int = 150, rate: float = 0.1,
) -> OrdinalModel:
    """Adam on the mean negative log-likelihood of the grades. Grades that do not occur
    get a threshold too, but no weight in the fit."""
    if len(np.unique(grades)) < 2:
        return OrdinalModel(np.zeros(size, np.float32), np.full(n_grades - 1, -30.0))
    n = len(rows)
    seen = np.zeros(size, np.int32)
    for i, _ in rows:  # the slots of a row are distinct
        seen[i] += 1
    often = seen >= min_docs  # rarer features would only be learnt by heart
    cols, column = np.flatnonzero(often), np.cumsum(often, dtype=np.int32) - 1
    rows = [(column[i[k]], v[k].astype(np.float32)) for i, v in rows for k in [often[i]]]
    at = np.repeat(np.arange(n, dtype=np.int32), [len(i) for i, _ in rows])
    index, value = (np.concatenate(x) for x in zip(*rows))
    del rows
    share = np.bincount(grades, minlength=n_grades) / n
    below = np.clip(np.cumsum(share)[:-1], 1e-3, 1 - 1e-3)
    start = np.log(below / (1 - below))
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate([np.zeros(len(cols)), [first], gaps])
    mean, spread = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, (first, *gaps) = params[: len(cols)], params[len(cols) :]
        t = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        f = np.bincount(at, value * w[index], minlength=n)
        # cumulative probabilities at the upper and the lower threshold of the grade
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        up, low = (1 / (1 + np.exp(np.clip(f - edge[g], -500, 500))) for g in (grades + 1, grades))
        mass = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up), low * (1 - low)
        d_score = (d_up - d_low) / mass / n
        d_t = np.array([
            (-d_up / mass * (grades == k) + d_low / mass * (grades == k + 1)).sum() / n
            for k in range(n_grades - 1)
        ])
        d_w = np.bincount(index, value * d_score[at], minlength=len(cols)) + ridge * w
        d_gaps = [d_t[k + 1 :].sum() * np.exp(g) for k, g in enumerate(gaps)]
        slope = np.concatenate([d_w, [d_t.sum()], d_gaps])
        mean, spread = 0.9 * mean + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        params -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[cols] = params[: len(cols)]
    first, *gaps = params[len(cols) :]
    return OrdinalModel(weights, first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Toxic ranks below low quality; null if a rating is null or not 0 or 1."""
    known = quality.isin(0, 1) & toxic.isin(0, 1)
    return F.when(known, F.when(toxic == 1, 0).otherwise(quality + 1)).cast("int")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fitted on the ``sample_rows`` labelled documents whose ids hash lowest."""
    graded = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        grade_of(F.col("quality"), F.col("toxic")).alias("grade"),
    ).where("grade IS NOT NULL AND doc_id IS NOT NULL")
    sample = hash_sample(graded, ["doc_id"], sample_rows, graded.count())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "grade int, slots array<int>, weights array<float>"

    def featured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = TextFeatures()
        for part in parts:
            found = [features(t) for t in part["text"]]
            yield pd.DataFrame({
                "grade": part["grade"],
                "slots": [i.astype(np.int32) for i, _ in found],
                "weights": [v.astype(np.float32) for _, v in found],
            })

    # the sample is bounded by sample_rows, so it may be sent to every task
    picked = texts.join(F.broadcast(sample), "doc_id").select("grade", "text")
    got = picked.mapInPandas(featured, schema).toPandas()
    rows = [
        (np.asarray(i, np.int32), np.asarray(v, np.float32))
        for i, v in zip(got.pop("slots"), got.pop("weights"))
    ]
    return fit_ordinal(rows, got["grade"].to_numpy(np.int64), 1 << HASH_BITS)


def score(docs: DataFrame, model: OrdinalModel, into: str = "rating") -> DataFrame:
    """``docs`` with a struct ``into``: score, expected_grade, tails and accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a vector of 2^HASH_BITS
    kind = T.StructType([
        T.StructField("score", T.DoubleType()),
        T.StructField("expected_grade", T.DoubleType()),
        T.StructField("tails", T.ArrayType(T.DoubleType())),
        T.StructField("accepted", T.BooleanType()),
    ])

    @F.pandas_udf(kind)
    def rated(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, features = shared.value, TextFeatures()
        for part in texts:
            found = [features(t) for t in part]
            f = np.array([(own.weights[i] * v).sum() for i, v in found], dtype=float)
            tails = own.tails(f)
            yield pd.DataFrame({
                "score": f,
                "expected_grade": tails.sum(axis=1),
                "tails": list(tails),
                "accepted": tails[:, ACCEPT_FROM - 1] >= ACCEPT_TAIL,
            })

    return docs.withColumn(into, rated(F.col("text")))
