"""Every registered query against its SQL counterpart, over the whole given tables."""

import pytest
from compare import difference, sql_connection

from __spark_entry__ import entry
from stockyard.plans.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_connection(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], FOLDER) is None


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
