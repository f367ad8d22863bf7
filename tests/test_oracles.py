"""Every registered query against its oracle, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import registry
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert compare(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
