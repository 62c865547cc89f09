from __future__ import annotations

from collections import Counter

from edge import CLASHING, edge_docs, edge_rows, no_docs

from tierstone.llm.line_dedup import LineRuns, drop_repeated_lines

SPACE = " \t\n\x0b\f\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs=5, min_chars=40):
    held, largest = Counter(), {}
    rank = lambda i: -(2**63) if i is None else i
    for doc_id, text in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            held[key] += 1
            largest[key] = max(largest.get(key, rank(None)), rank(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(k := key_of(x)) < min_chars or held[k] < min_docs or largest[k] == rank(doc_id)
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(df, **how):
    found = drop_repeated_lines(df, **how).select(
        "doc_id", "lines_.n_lines", "lines_.n_dropped", "lines_.text"
    )
    return sorted(map(tuple, found.collect()), key=str)


def test_edges_match_brute_force(spark):
    expected = brute(edge_rows())
    assert sum(r[2] for r in expected) > 3
    assert run(edge_docs(spark), into="lines_") == expected
    assert run(edge_docs(spark), into="lines_", batches=7) == expected


def test_lines_found_only_without_ids_stay(spark):
    line = "a line that only documents without any id hold, five of them"
    rows = [(None, line)] * 6
    assert run(edge_docs(spark, rows), into="lines_") == brute(rows)


def test_empty_table(spark):
    assert run(no_docs(spark), into="lines_") == []


def test_other_columns_stay(spark):
    found = drop_repeated_lines(edge_docs(spark), into="lines_")
    assert found.columns == ["doc_id", "text", *CLASHING, "lines_"]
    assert found.count() == len(edge_rows())


def test_runs_are_levelled_and_find_unseen_lines(spark):
    runs = LineRuns(spark, min_chars=1, fanout=2)
    for k in range(5):
        runs.add(edge_docs(spark, [(k, f"line {k}\ncommon")]))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    total = {(r["n_docs"], r["max_doc"]) for r in runs.totals().collect()}
    assert (5, 4) in total and (1, 2) in total
    fresh = runs.unseen(edge_docs(spark, [(9, "Common\nline 3\nnew line")]))
    assert fresh.count() == 1
