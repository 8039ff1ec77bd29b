"""Every query against its check SQL, bit for bit, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

CHECKS = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def engine(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_check(spark, small, engine, name):
    assert difference(QUERIES[name](spark, small), engine, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_model_query_runs(spark, small, name):
    rows = QUERIES[name](spark, small).collect()
    assert rows or name in {"filter_tier_driver", "top5_critical_explanations", "explanation_page"}


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
