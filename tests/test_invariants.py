"""Properties that hold for any data."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sondaflow.measures import shapes
from sondaflow.operators import curate, facts
from sondaflow.specs import ColumnSpec, CurationSpec
from workload import marts, proxies

FOLDER = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")

SPEC = CurationSpec(
    source="raw", target="t", keys=("k", "d"), nullable_keys=("d",),
    columns=(ColumnSpec("k", "k", "string"), ColumnSpec("d", "d", "string"),
             ColumnSpec("a", "a", "double"), ColumnSpec("b", "b", "int")))
RAW = "k string, d string, a double, b int, _ingestion_timestamp timestamp, _batch_id string"

rows_strategy = st.lists(st.tuples(
    st.sampled_from("xyz"), st.sampled_from([None, "p", "q"]),
    st.one_of(st.none(), st.integers(0, 3).map(float)), st.one_of(st.none(), st.integers(0, 3)),
    st.integers(0, 2)), min_size=1, max_size=30)


def expected(rows):
    """The kept row per key in plain Python: nulls are below every value."""
    def rank(row):
        low = float("-inf")
        return row[4], low if row[2] is None else row[2], low if row[3] is None else row[3]

    best = {}
    for row in rows:
        if row[:2] not in best or rank(row) > rank(best[row[:2]]):
            best[row[:2]] = row
    return {k: (v[2], v[3]) for k, v in best.items()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, seed=st.integers(0, 99))
def test_deduplication_against_brute_force(spark, rows, seed):
    start = datetime(2024, 1, 1)
    mixed = random.Random(seed).sample(rows, len(rows))
    frame = spark.createDataFrame(
        [(k, d, a, b, start + timedelta(days=t), "b") for k, d, a, b, t in mixed], RAW)
    kept = curate.curated(frame.repartition(1 + seed % 4), SPEC).collect()
    assert {(r.k, r.d): (r.a, r.b) for r in kept} == expected(rows)
    assert len(kept) == len(expected(rows))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points=st.dictionaries(st.integers(0, 120), st.one_of(st.none(), st.integers(1, 9).map(float)),
                              min_size=1, max_size=25))
def test_highlight_against_brute_force(spark, points):
    first = date(2024, 1, 1)
    frame = spark.createDataFrame(
        [(first + timedelta(n), v) for n, v in points.items()], "data date, v double")
    chart = {r.data: r for r in shapes.with_highlight(
        frame, [], "v", "start", "history", "recent", "point").collect()}
    filled = sorted(n for n, v in points.items() if v is not None)
    back = [n for n in filled if filled and n <= filled[-1] - 30]
    start = (back[-1] if back else filled[0]) if filled else None
    for n, v in points.items():
        row = chart[first + timedelta(n)]
        assert row.start == (None if start is None else first + timedelta(start))
        assert row.history == (v if start is not None and n <= start else None)
        assert row.recent == (v if start is not None and n >= start else None)
        assert row.point == (v if filled and n == filled[-1] else None)


@given_tables
def test_signal_agrees_with_divergence(spark):
    rows = marts.comparison_fact(spark, FOLDER).withColumn(
        "sign", F.signum("divergencia_top5_mercado").cast("int"))
    found = {(r.sign, r.sinal_posicionamento) for r in rows.select("sign", "sinal_posicionamento").distinct().collect()}
    assert found <= {(1, facts.TOP5_ABOVE), (-1, facts.TOP5_BELOW), (0, facts.TOP5_AGREES)}
    assert len(found) == 3


@given_tables
@pytest.mark.parametrize("plan, spec, curated", [
    (proxies.market, proxies.SURVEY_SPEC, marts.curated_market),
    (proxies.news, proxies.SURVEY_SPEC, marts.curated_news),
    (proxies.panel, proxies.TOP5_SPEC, marts.curated_panel)])
def test_curation_keeps_every_key_once(spark, plan, spec, curated):
    keys = curate.typed(plan(spark, FOLDER), spec).select(*spec.keys).distinct()
    kept = curated(spark, FOLDER).select(*spec.keys)
    assert kept.count() == keys.count() == kept.distinct().count()


@given_tables
def test_history_and_recent_share_only_the_start(spark):
    star = marts.lines(spark, FOLDER, "expectations")
    daily = shapes.by_date(star.expectations, ["indicador"], {"v": "mediana"})
    chart = shapes.with_highlight(daily, ["indicador"], "v", "start", "history", "recent")
    assert chart.filter("history IS NULL AND recent IS NULL").count() == 0
    both = chart.filter("history IS NOT NULL AND recent IS NOT NULL")
    assert both.filter("data <> start").count() == 0
    assert both.count() == chart.select("indicador").distinct().count()
