"""Registered queries against their SQL on the smallest tables."""

import pytest
from oracle_check import connect, difference

from orderloom.registry.queries import ORACLE, QUERIES

@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, QUERIES[name], ORACLE[name], sf_dir) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as contract

    # The corpus operators may add to these, or be absent.
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= ORACLE.keys()
    assert contract.entry(spark).columns == [
        "header_id", "source_id", "customer_po", "store_number", "store_qty"
    ]
