"""Every registered query against its SQL oracle, on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from snapfold.plans.oracles import ORACLES
from snapfold.plans.registry import QUERIES
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 5
    costs = [r.total_salary_cost for r in rows]
    assert costs == sorted(costs, reverse=True)
