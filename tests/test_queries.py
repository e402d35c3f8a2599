"""Every registered query against its oracle SQL."""

import pytest

import __spark_entry__ as registry
import check
from termtide.checks import oracles
from termtide.checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return check.oracle(small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles.oracle_sql())
    assert set(QUERIES) <= set(registry.queries()) and set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).columns[:3] == ["tweet_month", "ngram", "count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, small, name):
    assert check.compare(spark, con, name, small) == ""
