from __future__ import annotations

import random

import numpy as np
import pytest
from edge import edge_docs, edge_rows, no_docs

from tierstone.llm.substrings import LENGTH, Chunk, remove_repeats


def brute(rows):
    first = {}
    rank = lambda i: 2**63 - 1 if i is None else i
    bodies = [((rank(i), i), (t or "").encode()) for i, t in rows]
    for (r, _), body in bodies:
        for at in range(len(body) - LENGTH + 1):
            own = body[at : at + LENGTH]
            first[own] = min(first.get(own, r), r)
    out = []
    for (r, doc_id), body in bodies:
        gone = np.zeros(len(body), dtype=bool)
        for at in range(len(body) - LENGTH + 1):
            if first[body[at : at + LENGTH]] < r:
                gone[at : at + LENGTH] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(body), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def run(df, **how):
    found = remove_repeats(df, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    return sorted(((*r[:4], bytes(r[4])) for r in found.collect()), key=str)


def test_edges_match_brute_force(spark):
    rows = [(i, (t or "")[:4000] if t is not None else None) for i, t in edge_rows()]
    assert run(edge_docs(spark, rows)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_periodic_and_overlapping_texts(spark, seed):
    rng = random.Random(seed)
    unit = lambda: "".join(rng.choice("ab\x00é") for _ in range(rng.randint(1, 40)))
    pool = [unit() * rng.randint(1, 60) for _ in range(8)]
    rows = [
        (rng.choice([None, *range(20)]), "".join(rng.choice(pool)[: rng.randint(10, 400)] for _ in range(4)))
        for _ in range(60)
    ]
    assert run(edge_docs(spark, rows), block_bytes=3000) == brute(rows)


def test_large_groups_of_near_copies(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(600))
    rows = []
    for k in range(200):
        at = rng.randint(0, 590)
        rows.append((k * 1000 % 977, base[:at] + str(k) + base[at:]))
    assert run(edge_docs(spark, rows), block_bytes=5000) == brute(rows)


def test_empty_table(spark):
    assert run(no_docs(spark)) == []


def test_anchors_are_sought_once(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab\x00é") for _ in range(n)).encode() for n in (0, 300, 12, 49, 50, 700)]
    first = Chunk(texts)
    monkeypatch.setattr(Chunk, "_find", lambda self: pytest.fail("sought again"))
    again = Chunk(texts, first.marks)
    for name in ("anchors", "of_string", "strings", "buckets"):
        assert np.array_equal(getattr(first, name), getattr(again, name)), name
    assert len(first.strings) == sum(max(len(t) - LENGTH + 1, 0) for t in texts)
    inside = first.anchors[first.of_string] - first.strings
    assert inside.min() >= 0 and inside.max() <= 26
