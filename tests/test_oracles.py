"""Every registered query against its DuckDB twin at the smallest scale."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry_module
from salesmart.plans import catalog, oracles


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_a_twin():
    assert set(catalog.REGISTRY) == set(oracles.build())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_query_matches_twin(spark, sf, duck, name):
    assert compare(spark, duck, sf, name) == ""


def test_entry(spark):
    df = entry_module.entry(spark)
    assert len(df.columns) == 25
    assert df.count() > 0
