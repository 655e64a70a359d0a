import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from vecsink.queries.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert compare(spark, connection, name, query, sql, SF) is None


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert "event_id" in frame.columns and frame.count() > 0
