"""What the plans must look like to hold at scale."""

import os
import re

import pytest

from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")

# These write tables and return audit rows or counts.
WRITING = {"landed_survey", "load_audit", "resumed_load", "curation_audit", "refreshed_tables", "refreshed_expectations",
           "refreshed_comparison", "refreshed_rates", "refreshed_tests", "refused_loads", "refused_curation",
           "replaced_and_widened", "paged_events", "windowed_orders", "window_counts"}
# Global aggregates and the daily rate series, where one partition holds one row per task or per day.
SINGLE = {"gate_metrics", "gate_metrics_clean", "duplicate_keys", "freshness_gate", "volume_gate",
          "join_fan_out", "test_not_null", "data_tests", "measure_cards", "last_date_colours",
          "rate_kpis_in_context", "rate_series", "report_rate_charts", "report_rate_cards",
          "report_latest_observation", "cards_in_conflict", "rate_points"}
# The last date of a whole fact is a scalar subquery, which gets one row per task.
LAST_DATE = {"last_date_divergence", "last_date_means", "rates_by_year", "report_comparison_table"}
# The members of a dimension, or the few of a fact's column, are one array beside the values they do not filter.
SPREAD = {"calendar_free_by_month", "divergence_by_signal", "divergence_by_owned_year", "measure_set_by_quarter"}


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_plan_has_an_unscalable_operator(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "Python",
                     "InMemoryTableScan", *([] if name in SPREAD else ["ObjectHashAggregate"])):
        assert operator not in plan
    if name not in SINGLE | LAST_DATE | SPREAD:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name, shuffles", [
    ("curated_market", 1), ("fact_expectations", 1), ("gate_metrics", 1), ("median_by_series", 1),
    ("cross_fact_divergence", 1), ("single_values", 1),
    ("highlight_series", 2), ("kpi_last_median", 2), ("kpi_divergence", 2), ("test_unique", 1)])
def test_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange (hash|Single|range)", plan_of(spark, name))) == shuffles


def test_several_measures_share_a_scan(spark):
    """One scan per fact: the cards of a fact, and the rates on their last date, are one aggregate."""
    assert plan_of(spark, "measure_cards").count("FileScan") == 3
    for name in ("single_rates", "divergence_signs", "comparison_means", "comparison_points", "rate_histories"):
        plan = plan_of(spark, name)
        assert len(re.findall(r"FileScan parquet .*(real_rate|comparison)-", plan)) == 1
        assert len(re.findall(r"Exchange hash", plan)) <= 2
    assert len(re.findall(r"Exchange hash", plan_of(spark, "last_date_divergence"))) == 1


def test_a_set_of_measures_scans_each_fact_once(spark):
    """Charts and the table are one call each; measures with a last date of their own add a scan."""
    for name, fact in (("report_overview_charts", "expectations"), ("report_comparison_charts", "comparison")):
        plan = plan_of(spark, name)
        assert len(re.findall(rf"FileScan parquet .*{fact}-", plan)) == 1
        assert len(re.findall(r"Exchange hash", plan)) == 2
    plan = plan_of(spark, "report_comparison_table")
    assert len(re.findall(r"FileScan parquet \[data#\d+,indicador.*comparison-", plan)) == 1
    quarter = plan_of(spark, "measure_set_by_quarter")
    assert len(re.findall(r"FileScan parquet \[[^\]]*mediana[^\]]*\].*(expectations|comparison)-", quarter)) == 2


def test_data_tests_scan_each_table_once(spark):
    plan = plan_of(spark, "data_tests")
    assert plan.count("FileScan parquet") == 4  # three facts, the indicators


def test_building_a_query_over_built_marts_starts_no_job(spark):
    names = set(QUERIES) - WRITING
    for name in names:
        QUERIES[name](spark, FOLDER)
    spark.sparkContext.setJobGroup("plans", "built only")
    try:
        for name in names:
            QUERIES[name](spark, FOLDER)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans")


def test_report_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(spark, "report_overview_charts")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    for pushed in ("EqualTo(ano_referencia,2002)", "EqualTo(base_calculo,0)",
                   "GreaterThanOrEqual(data,2001-06-01)", "LessThanOrEqual(data,2001-11-30)"):
        assert pushed in scan
    assert "ReadSchema: struct<data:date,indicador:string,ano_referencia:int,base_calculo:int,mediana:double>" in scan


def test_a_chart_needs_one_sort_for_all_its_windows(spark):
    plan = plan_of(spark, "highlight_series")
    assert len(re.findall(r"\bSort \[", plan)) == 1


def test_gates_read_each_row_once(spark):
    assert plan_of(spark, "gate_metrics_clean").count("FileScan") == 1
    assert plan_of(spark, "duplicate_keys").count("FileScan") == 1
