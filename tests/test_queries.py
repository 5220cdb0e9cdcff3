"""Every registered query against its DuckDB formulation at the smallest scale."""

import pytest

import __spark_entry__ as entry
from layerflow.plans.registry import QUERIES
from oracle_check import check

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "__START_AT" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = check(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["match"], r
