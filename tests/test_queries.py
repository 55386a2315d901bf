"""Every registered query against its SQL over the provided tables."""

import os

import pytest

import oracle
from dayloom.plans.queries import QUERIES, SQL

TABLES = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the provided tables are not there")


@pytest.fixture(scope="module")
def database():
    return oracle.connect(TABLES)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    assert oracle.compare(spark, database, TABLES, name, QUERIES[name], SQL[name]) is None
