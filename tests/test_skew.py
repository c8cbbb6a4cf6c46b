"""A third of all rows on one key: results stay those of the SQL."""

import duckdb
import pytest

from compare import TABLES, compare, connection
from workload.oracles import ORACLES
from workload.queries import QUERIES

SOURCE = "/root/testdata/sf0.001"
NAMES = ["curated_survey", "curated_panel", "curated_market", "curated_rate", "duplicate_keys",
         "fact_market_vs_top5", "fact_market_vs_top5_news", "fact_real_rate", "join_fan_out",
         "test_unique", "test_relationships", "calendar_rollup", "cross_fact_divergence",
         "highlight_series", "kpi_last_median", "kpi_divergence", "report_comparison_table"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SOURCE}/{table}.parquet'")
    copies = {
        "lineitem": """
            SELECT * FROM lineitem UNION ALL
            SELECT l_orderkey + 1000000, l_partkey, 1, 1, l_quantity, l_extendedprice + 1, l_discount,
                   l_tax, 'R', 'O', TIMESTAMP '1998-06-15' FROM lineitem, range(2)
            WHERE l_linestatus = 'O'""",
        "events": """
            SELECT * FROM events UNION ALL
            SELECT event_id + 1000000, TIMESTAMP '2024-01-15 03:04:05', 1, 'view', value + 1, '{"k": 45}'
            FROM events""",
        "orders": """
            SELECT * FROM orders UNION ALL
            SELECT o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice + 1,
                   TIMESTAMP '1998-06-15', o_orderpriority FROM orders""",
    }
    for table in TABLES:
        rows = copies.get(table, f"SELECT * FROM {table}")
        con.execute(f"COPY ({rows}) TO '{target}/{table}.parquet' (FORMAT parquet)")
    return str(target)


@pytest.mark.parametrize("name", NAMES)
def test_hot_key(spark, folder, name):
    assert compare(spark, connection(folder), QUERIES[name], ORACLES[name], folder) is None
