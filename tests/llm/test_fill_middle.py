from __future__ import annotations

import hashlib

import pytest
from edge import edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from tierstone.llm import fill_middle as fm
from tierstone.llm import queries


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in fm.MARKERS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return n, "psm", a, b - a, f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def test_rows_are_those_of_slices(spark):
    texts = ["<", "<S", "a<P>b", "$1\\$2\\", "<P", "é\U0001f600́x" * 700, "\n\r \x00" * 300, "S>M><"]
    rows = edge_rows() + [(100 + k, texts[k % len(texts)]) for k in range(160)]
    cut = fm.fill_in_middle(edge_docs(spark, rows))
    back = fm.restored(F.col("fim.output"), F.col("fim.form")).alias("back")
    found = cut.select("doc_id", "text", "fim.*", back).collect()
    assert len(found) == len(rows)
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    key = repr
    assert sorted(((r["doc_id"], r["text"], *(r[n] for n in names)) for r in found), key=key) == sorted(
        ((i, t, *brute(i, t)) for i, t in rows), key=key
    )
    assert all(r["back"] == (r["text"] or "") for r in found)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_columns_stay_and_very_long_texts_are_cut_whole(spark):
    long = "ab\U0001f600\n" * 400_000
    docs = edge_docs(spark, [(k, long) for k in range(3)])
    cut = fm.fill_in_middle(docs, into="made")
    assert cut.columns == [*docs.columns, "made"]
    for r in cut.select("doc_id", "made.*").collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], long)
    assert fm.fill_in_middle(no_docs(spark)).count() == 0


def test_other_markers_and_rates(spark):
    docs = edge_docs(spark, [(k, "some $1 text") for k in range(50)])
    markers = ("[$1\\E", "[^2", "[.*3")
    cut = fm.fill_in_middle(docs, markers=markers, cut=100, suffix_first=50)
    back = fm.restored(F.col("fim.output"), F.col("fim.form"), markers)
    rows = cut.select("fim.*", back.alias("back")).collect()
    assert {r["back"] for r in rows} == {"some $1 text"}
    assert {r["form"] for r in rows} == {"psm", "spm"}
    assert all(m in r["output"] for m in markers for r in rows)
    with pytest.raises(ValueError):
        fm.fill_in_middle(docs, markers=("<<", "<S>", "<M>"))


def test_plan_has_no_python(spark, sf_dir, capsys):
    queries.op13_fill_middle(spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan
