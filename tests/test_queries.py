"""Every registered query against its SQL twin at the smallest scale."""

import pytest

import __spark_entry__ as driver
import oracle

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.QUERIES, driver.ORACLES


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    assert oracle.compare(QUERIES[name](spark, SF), tables, ORACLES[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 1500
