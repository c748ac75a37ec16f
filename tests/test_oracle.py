"""Every registered query against its SQL."""

import sys

import pytest
from conftest import ROOT, SMALL

sys.path.insert(0, f"{ROOT}/tools")

from check_oracle import difference, open_oracle  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    assert difference(queries()[name](spark, SMALL), oracle, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 10
