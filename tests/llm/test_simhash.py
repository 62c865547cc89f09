from __future__ import annotations

import numpy as np
import pytest
import xxhash
from edge import CLASHING, edge_docs, edge_rows, no_docs

from tierstone.llm import simhash
from tierstone.llm.components import connected_components


def brute_print(text, shingle=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    cut = [words[k : k + shingle] for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(c).encode(), 42) for c in cut]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius):
    ids = [2**63 - 1 if i is None else i for i in ids]
    root = list(range(len(ids)))
    near = lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= radius
    changed = True
    label = list(ids)
    while changed:
        changed = False
        for a in root:
            for b in root:
                if near(a, b) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return [None if x == 2**63 - 1 else x for x in label]


def test_edges_match_brute_force(spark):
    rows = edge_rows()
    prints = [brute_print(t) for _, t in rows]
    label = brute_components([i for i, _ in rows], prints, 4)
    expected = sorted(((i, p, c) for (i, _), p, c in zip(rows, prints, label)), key=str)
    found = simhash.near_duplicates(edge_docs(spark)).collect()
    assert sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in found), key=str) == expected
    assert len({c for c in label}) < len(rows) - 3


@pytest.mark.parametrize("tile", [8192, 7])
def test_links_match_brute_force(spark, tile):
    rng = np.random.default_rng(tile)
    seeds = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = set()
    for seed in seeds.tolist():
        for _ in range(25):
            flips = rng.choice(64, int(rng.integers(0, 7)), replace=False)
            prints.add(seed ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    label = brute_components(list(range(len(prints))), prints, 4)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.fingerprint_links(frame, 4, tile)
    pairs = [(r["u"] & (1 << 64) - 1, r["v"] & (1 << 64) - 1) for r in edges.collect()]
    assert all(bin(a ^ b).count("1") <= 4 * 12 for a, b in pairs)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = lambda names: sorted(sorted(p for p, n in zip(prints, names) if n == m) for m in set(names))
    assert groups([find(p) for p in prints]) == groups(label)


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_planes_count_like_popcount(radius):
    rng = np.random.default_rng(radius)
    n = 500
    fp = rng.integers(0, 1 << 63, n, dtype=np.uint64) & np.uint64(0xFFF)
    bits = np.zeros((64, 1024), np.uint8)
    bits[:, :n] = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    for d in (1, 5, 63, 64, 100):
        valid = rng.random(n - d) < 0.7
        near = np.bitwise_count(fp[: n - d] ^ fp[d:]) <= radius
        found = simhash.close_lanes(planes, n - d, d, radius, valid)
        assert found.tolist() == np.flatnonzero(near & valid).tolist()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    edges = spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert found == {k: 100 for k in range(100, 161)} | {7: 7} | {k: 7 for k in range(200, 260)}


def test_one_row_of_each_group_stays(spark):
    rows = edge_rows()
    kept = simhash.keep_representatives(edge_docs(spark))
    assert kept.columns == ["doc_id", "text", *CLASHING]
    # a row's place names its component, as ids repeat
    place = brute_components(list(range(len(rows))), [brute_print(t) for _, t in rows], 4)
    heads = [min((rank(i) for (i, _), p in zip(rows, place) if p == own)) for own in set(place)]
    assert sorted(rank(r["doc_id"]) for r in kept.collect()) == sorted(heads)


def rank(doc_id):
    return 2**63 - 1 if doc_id is None else doc_id


def test_empty_table(spark):
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    assert simhash.keep_representatives(no_docs(spark)).count() == 0
