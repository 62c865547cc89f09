from __future__ import annotations

import numpy as np
import pytest

from tierstone.llm import neighbours


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, None) for i, v in rows], "vec_id long, embedding array<float>, score string"
    )


def brute(rows, k, every):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        best.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in (i for i in best if i % every == 0):
        scores = [(-max(float(a @ b) for a in best[q] for b in best[i]), i) for i in best if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def clusters(seed, n, d=16, centres=25):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, d))
    x = middle[rng.integers(0, centres, n)] + 0.4 * rng.standard_normal((n, d))
    return [(k, v.astype(np.float32).tolist()) for k, v in enumerate(x)]


def run(spark, rows, k=20, every=20):
    found = neighbours.nearest(frame(spark, rows), lambda i: i % every == 0, k).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


@pytest.mark.parametrize("list_rows", [400, 40])
def test_recall_and_order(spark, monkeypatch, list_rows):
    monkeypatch.setattr(neighbours, "LIST_ROWS", list_rows)
    rows = clusters(1, 3000)
    found, expected = run(spark, rows), brute(rows, 20, 20)
    assert found.keys() == expected.keys()
    hit = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 20 for q in expected]
    assert np.mean(hit) >= 0.9
    for own in found.values():
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and len(own) == 20


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (3, [0.5, 0.5]),
        (4, None), (5, []), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]),
        (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (10, [-3.0, 1.0]), (11, [-0.0, 2.0]),
    ]
    expected = brute([r for r in rows if r[1] != []], 3, 2)
    found = run(spark, rows, 3, 2)
    assert {q: [i for i, _ in own] for q, own in found.items()} == {
        q: [i for i, _ in own] for q, own in expected.items()
    }
    assert found[0] == [(1, 1.0), (2, 1.0), (3, 0.5)]


def test_many_equal_vectors(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(200)] + [(1000 + k, [1.0, 2.0, 3.1 + k]) for k in range(5)]
    found = run(spark, rows)
    assert found == brute(rows, 20, 20)


def test_small_far_groups_beside_dense_clusters(spark, monkeypatch):
    """Groups of ten copies, far from everything: on some lies a centroid."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 40)
    rows = [(k, [*v, *[0.0] * 20]) for k, v in clusters(6, 3000)]
    for group in range(20):
        far = [0.0] * 36
        far[16 + group] = 6.0
        rows += [(3000 + 20 * group + copy, far) for copy in range(10)]
    found = run(spark, rows)
    assert {q: len(own) for q, own in found.items()} == {q: 20 for q in found}
    assert len(found) == 170
    for group in range(20):
        q = 3000 + 20 * group
        assert [i for i, _ in found[q]][:9] == list(range(q + 1, q + 10))


def test_empty_table(spark):
    assert run(spark, []) == {}
    assert run(spark, [(20, None)]) == {}


def test_boundary_vectors_are_copied():
    index = neighbours.Index(np.array([[0.0, 0.0, 1.0], [1.0, 0.0, 1.0]]), np.zeros((2, 0), int), 1.0)
    stored = [(r, c) for at, lists in index.lists_of(np.array([[0.5, 0.0], [0.1, 0.0]])) for r, c in zip(at, lists)]
    assert sorted(stored) == [(0, 0), (0, 1), (1, 0)]


def test_a_query_id_with_several_vectors_counts_once(spark):
    rows = clusters(4, 600)
    rows += [(20, rows[7][1]), (20, rows[8][1]), (40, rows[9][1]), (33, rows[20][1])]
    found, expected = run(spark, rows), brute(rows, 20, 20)
    for q, own in found.items():
        assert len({i for i, _ in own}) == len(own) == 20 and q not in dict(own)
    hit = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 20 for q in expected]
    assert np.mean(hit) >= 0.9


def test_recall_on_given_vectors(spark):
    rows = [
        (r["vec_id"], list(r["embedding"]))
        for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ]
    found, expected = run(spark, rows), brute_matrix(rows)
    hit = [len({i for i, _ in found[q]} & expected[q]) / 20 for q in expected]
    assert np.mean(hit) >= 0.9


def brute_matrix(rows, k=20, every=20):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = x @ x[q]
        score[q] = -np.inf
        out[int(ids[q])] = set(ids[np.lexsort((ids, -score))[:k]].tolist())
    return out
