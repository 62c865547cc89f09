"""Every query against the same query in DuckDB."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as spark_entry
from tierstone.workload import oracle, registry

QUERIES, ORACLE = registry.queries(), oracle.oracle_sql()

@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_listing_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns[0] == "trade_date"
    assert result.count() > 0


@pytest.mark.parametrize(
    "name", [k for k in sorted(QUERIES) if k.startswith("bench_") and k.endswith("_legacy")]
)
def test_both_layouts_agree(spark, sf_dir, name):
    flat = QUERIES[name](spark, sf_dir)
    partitioned = QUERIES[name.removesuffix("_legacy")](spark, sf_dir).select(*flat.columns)
    assert sorted(map(str, flat.collect())) == sorted(map(str, partitioned.collect()))
