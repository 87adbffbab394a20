"""Every registered query with an oracle, on the smallest sample."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    ok, message, _ = compare(spark, con, FOLDER, name, entry.queries()[name], ORACLES[name])
    assert ok, message


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
