"""The queries that SQL can express, against their SQL."""

import oracle_check
import pytest
from conftest import SF_DIR

from fareflow.llm import queries


@pytest.fixture(scope="module")
def duck():
    con = oracle_check.connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_matches_oracle(spark, duck, name):
    assert oracle_check.difference(queries.queries()[name](spark, SF_DIR), duck, queries.oracles()[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
