"""Small tables with nulls, empty and long texts, repeated rows and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SHARED = "This very line of text is found in quite a few of the documents here."
CLASHING = {
    "key": "int", "lines": "string", "found": "string", "words": "string", "own_id": "long",
    "fp_": "long", "row_": "long", "rating": "double", "leak": "string", "gone": "string",
}


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def edge_rows(seed: int = 1) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    base = words(rng, 300)
    near = base.split()
    near[150] = "changed"
    rows = [
        (None, "A text without an id.\n" + SHARED),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n\n "),
        (4, "x"),
        (5, base),
        (6, base),
        (6, base),
        (7, " ".join(near)),
        (8, words(rng, 20_000) + "\n" + SHARED),
        (9, "a" * 700),
        (10, "ab" * 300 + "c"),
        (10, "the same id, another text\n" + SHARED),
        (11, "\n".join([SHARED, words(rng, 30), "  " + SHARED.upper() + "\t"])),
        (12, SHARED + " "),
        (13, "Ünïcode \U0001f600 text\r\n" + SHARED),
        (-7, base[:400] + "\n" + SHARED),
    ]
    return rows


def edge_docs(spark: SparkSession, rows=None) -> DataFrame:
    """(doc_id, text) and columns whose names the operators use themselves."""
    rows = edge_rows() if rows is None else rows
    schema = "doc_id long, text string, " + ", ".join(f"{n} {t}" for n, t in CLASHING.items())
    return spark.createDataFrame([(*r, *[None] * len(CLASHING)) for r in rows], schema)


def no_docs(spark: SparkSession) -> DataFrame:
    return edge_docs(spark, [])
