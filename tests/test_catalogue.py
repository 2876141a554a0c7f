"""Every registered query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests import compare

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(D)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, duck, name):
    note, _, good = compare.compare(spark, duck, name, D)
    assert good, note


def test_contract(spark):
    assert entry(spark).columns
    assert set(oracle_sql()) <= set(queries())
