from __future__ import annotations

import pytest
import test_decontaminate
import test_line_dedup
import test_packing
import test_simhash
from edge import edge_docs, edge_rows, no_docs
from oracle_check import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
import corpus_pipeline
from tierstone.llm.queries import oracle_sql, queries, table, tokenizer_path


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows that each stage took and gave."""
    docs = table(spark, sf_dir, "documents")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        docs = corpus_pipeline.Stored(stage(spark, docs, sf_dir), "tested").df
        found.append((name, given, docs.collect()))
    return found


def texts(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_quality_keeps_good_documents(stages, spark, sf_dir):
    _, given, kept = stages[0]
    labels = {r["doc_id"]: r for r in table(spark, sf_dir, "labels").collect()}
    ids = {r["doc_id"] for r in kept}
    good = [r["doc_id"] for r in given if (x := labels.get(r["doc_id"])) and x["quality"] and not x["toxic"]]
    toxic = [i for i, x in labels.items() if x["toxic"]]
    assert sum(i in ids for i in good) >= 0.98 * len(good) and not ids & set(toxic)


def test_lines(stages):
    _, given, kept = stages[1]
    expected = [(i, t) for i, _, _, t in test_line_dedup.brute(texts(given))]
    assert sorted(texts(kept), key=str) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in kept)


def test_near_copies(stages):
    _, given, kept = stages[2]
    prints = [test_simhash.brute_print(t) for _, t in texts(given)]
    label = test_simhash.brute_components([r["doc_id"] for r in given], prints, 4)
    assert sorted(r["doc_id"] for r in kept) == sorted(set(label))


def test_leaks(stages, spark, sf_dir):
    _, given, kept = stages[3]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    clean = [r[0] for r in test_decontaminate.brute(texts(given), items) if not r[2]]
    assert sorted(r["doc_id"] for r in kept) == sorted(clean)


def test_pieces_are_packed(stages):
    _, given, packed = stages[4]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    test_packing.check(packed, tokenizer, texts(given), 2048)


def test_stages_keep_the_columns(spark, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        given = edge_docs(spark)
        assert stage(spark, given, sf_dir).columns == given.columns
        assert stage(spark, no_docs(spark), sf_dir).count() == 0
    assert len(corpus_pipeline.STAGES) == 5


def test_run_is_the_stages(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    place = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(place, found)) == sorted(map(place, stages[-1][2]))


def test_edge_rows_survive_the_pipeline(spark, sf_dir):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.Stored(stage(spark, docs, sf_dir), "tested").df
    assert 0 < docs.count() and len(edge_rows()) > 10


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    small = "/root/testdata/sf0.01"
    assert differences(queries()[name](spark, small), connect(small), oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = set(spark_entry.queries())
    assert set(queries()) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries()} == {f"op{k}" for k in range(1, 11)}
