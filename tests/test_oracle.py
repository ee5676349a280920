"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import oracle_check
from conftest import SF_DIR
from fareflow.catalog import registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def duck():
    con = oracle_check.connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    assert oracle_check.difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "revenue_monthly_fare" in df.columns
