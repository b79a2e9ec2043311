"""Every registered query against its oracle SQL on the smallest tables."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, data, name):
    message, _, _ = compare(spark, con, data, QUERIES[name], ORACLES[name])
    assert message is None, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, con, data, name):
    _, rows, _ = compare(spark, con, data, QUERIES[name], None)
    assert rows > 0


def test_entry(spark, data):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
