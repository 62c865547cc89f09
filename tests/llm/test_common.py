from __future__ import annotations

from edge import edge_docs, edge_rows, no_docs

from tierstone.llm.common import Stored, fresh_name, hash_sample, row_key


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    first, again = (
        sorted(r[0] for r in hash_sample(part, ["doc_id"], 100, 5000).collect())
        for part in (rows, rows.repartition(7))
    )
    assert first == again and 90 <= len(first) <= 100
    assert hash_sample(rows, ["doc_id"], 9000, 5000).count() == 5000
    assert hash_sample(rows.where("false"), ["doc_id"], 10, 0).count() == 0


def test_row_key_tells_rows_apart(spark):
    docs = edge_docs(spark)
    assert docs.select(row_key(docs)).distinct().count() == len(set(edge_rows()))


def test_names_and_stored_tables(spark):
    docs = edge_docs(spark)
    assert fresh_name(docs, "KEY") == "KEY_"
    stored = Stored(docs, "test")
    assert stored.df.count() == len(edge_rows())
    stored.drop()
    assert Stored(no_docs(spark), "test").df.count() == 0
