"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as contract
from compare import assert_same, oracle_connection
from topicwright.plans.oracles import ORACLES
from topicwright.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 1000
