"""The registered operators against their SQL on the given tables."""

import pytest

import __spark_entry__ as entry_points
from compare import compare, connection
from sondaflow.llm.oracles import ORACLES
from sondaflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert names == list(QUERIES) == sorted(names, key=lambda n: int(n[2:].split("_")[0])) and len(names) == 13
    assert "pipeline" in entry_points.queries()
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert compare(spark, connection(FOLDER), QUERIES[name], ORACLES[name], FOLDER) is None
