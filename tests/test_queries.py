"""Every registered query against its SQL twin on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from queries import ORACLE, QUERIES
from tests import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert oracle.compare(df, con, ORACLE[name]) is None


def test_entry_offers_all_queries():
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
