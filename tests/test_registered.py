"""Every registered query against its SQL on the smallest test tables."""

import pathlib

import pytest

import __spark_entry__ as registered
from tests.oracle import compare, connect
from tidemark.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registered.queries().keys() and ORACLES.keys() <= registered.oracle_sql().keys()


def test_entry(spark):
    assert registered.entry(spark).columns == ["name", "amount_sum"]
