from __future__ import annotations

import random
import re

import pytest
from edge import CLASHING, edge_docs, edge_rows, no_docs

from tierstone.llm.common import Stored, row_key
from tierstone.llm.decontaminate import PositionalIndex, mark_contaminated, test_windows

test_windows.__test__ = False
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + window]), set()).add(str(item) if item is not None else None)
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for own, names in windows.items():
            for at in range(len(w) - len(own) + 1):
                if tuple(w[at : at + len(own)]) == own:
                    hit |= set(range(at, at + len(own)))
                    found |= names - {None}
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(docs, benchmark, **how):
    found = mark_contaminated(docs, benchmark, into="leak_", **how)
    return sorted(
        map(tuple, found.select("doc_id", "leak_.n_words", "leak_.n_hit", "leak_.items").collect()),
        key=str,
    )


def items_frame(spark, items):
    rows = [(i, t, None) for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, words string")


ITEMS = [
    (1, "This VERY line, of text is found in quite a few of the documents here!"),
    (2, "of the documents here"),
    (2, "of the documents here"),
    (30, "a few; of the documents"),
    (4, None),
    (5, "--- !!"),
    (None, "This very line of text is found in quite a"),
    (7, "aaaa never there aaaa never there aaaa never there more"),
    (8, "x"),
]


def test_edges_match_brute_force(spark):
    expected = brute(edge_rows(), ITEMS)
    assert sum(r[2] > 0 for r in expected) >= 6
    assert run(edge_docs(spark), items_frame(spark, ITEMS)) == expected


@pytest.mark.parametrize("window", [1, 3])
def test_repetitive_texts(spark, window):
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    rows = [(k, text(40)) for k in range(30)]
    items = [(k, text(5)) for k in range(4)]
    assert run(edge_docs(spark, rows), items_frame(spark, items), window=window) == brute(
        rows, items, window
    )


def test_empty_tables(spark):
    assert run(no_docs(spark), items_frame(spark, ITEMS)) == []
    assert run(edge_docs(spark), items_frame(spark, [])) == brute(edge_rows(), [])


def test_other_columns_stay(spark):
    found = mark_contaminated(edge_docs(spark), items_frame(spark, ITEMS), into="leak_")
    assert found.columns == ["doc_id", "text", *CLASHING, "leak_"]


def test_proximity(spark):
    rows = [(1, "red x x green x blue"), (2, "blue green red"), (3, "red x x x x x x green blue"), (4, "red green")]
    windows = Stored(test_windows(items_frame(spark, [(1, "red green blue")])), "w").df
    docs = edge_docs(spark, rows)
    key = {r["key"]: r["doc_id"] for r in docs.select("doc_id", row_key(docs).alias("key")).collect()}
    near = PositionalIndex(docs, windows).near(6)
    assert sorted(key[r["d"]] for r in near.collect()) == [1, 2]
