"""Run registered queries and their SQL side by side: columns, row counts and values."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else float(f"{number:.12g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def compare(spark, con, query, sql: str, folder: str) -> str | None:
    """None when both agree, else what differs."""
    frame = query(spark, folder)
    cursor = con.execute(sql)
    theirs = [d[0] for d in cursor.description]
    if sorted(frame.columns) != sorted(theirs):
        return f"columns {sorted(set(frame.columns) ^ set(theirs))}"
    order = sorted(theirs)
    spark_rows = Counter(tuple(plain(r[c]) for c in order) for r in frame.collect())
    index = [theirs.index(c) for c in order]
    duck_rows = Counter(tuple(plain(r[i]) for i in index) for r in cursor.fetchall())
    if not spark_rows:
        return "no rows"
    if spark_rows != duck_rows:
        only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
        return (f"rows {sum(spark_rows.values())} / {sum(duck_rows.values())}, differ "
                f"{sum(only_spark.values())} / {sum(only_duck.values())}: {order} "
                f"{list(only_spark)[:2]} / {list(only_duck)[:2]}")
    return None
