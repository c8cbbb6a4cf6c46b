"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import compare, connection
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert "sinal_posicionamento" in frame.columns and frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert compare(spark, con, query, sql, FOLDER) is None
