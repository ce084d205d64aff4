"""Every driver query against its SQL, on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference
from textgraph_checks import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_of_the_checks_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).columns == ["rank", "doc_id", "relevance"]


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_as_sql(spark, name):
    want = connect(SF_DIR).sql(oracle_sql()[name]).df()
    assert difference(queries()[name](spark, SF_DIR).toPandas(), want) is None
