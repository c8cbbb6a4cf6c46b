from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sondaflow.operators import checks, dims, facts
from sondaflow.plans import catalog
from sondaflow.specs import CalendarRange, ColumnTest

SURVEY = ("data date, indicador string, indicador_detalhe string, ano_referencia int, "
          "base_calculo int, media double, mediana double, desvio_padrao double, minimo double, "
          "maximo double, numero_respondentes int")
TOP5 = ("data date, indicador string, ano_referencia int, tipo_calculo string, media double, "
        "mediana double, desvio_padrao double, minimo double, maximo double")
DAY = date(2024, 1, 2)


def survey(spark, *rows):
    """(indicator, detail, base, median)"""
    return spark.createDataFrame(
        [(DAY, i, d, 2026, b, 1.0, m, 0.1, 1.0, 2.55, 9) for i, d, b, m in rows], SURVEY)


def top5(spark, *rows):
    """(indicator, type, median)"""
    return spark.createDataFrame(
        [(DAY, i, 2026, t, 1.0, m, 0.1, 1.0, 2.0) for i, t, m in rows], TOP5)


def test_calendar(spark):
    cal = dims.calendar(spark)
    assert list(dims.CALENDAR_COLUMNS) == cal.columns
    assert cal.count() == 14975 == cal.select("data_sk").distinct().count()
    first = cal.orderBy("data").first()
    assert (first.data, first.data_sk, first.dia_semana_num, first.dia_semana_nome,
            first.flg_dia_util_teorico, first.nome_mes, first.ano_mes, first.semestre,
            first.trimestre) == (date(1995, 1, 1), 19950101, 1, "Sunday", 0, "January", "1995-01", 1, 1)
    ends = cal.agg(F.min("data"), F.max("data")).first()
    assert tuple(ends) == (date(1995, 1, 1), date(2035, 12, 31))
    short = dims.calendar(spark, CalendarRange(date(2024, 2, 28), date(2024, 3, 1)))
    assert [r.dia for r in short.orderBy("data").collect()] == [28, 29, 1]


def test_indicator_dimension(spark):
    rows = dims.indicators(spark).orderBy("indicador_id").collect()
    assert [r.indicador for r in rows] == ["IPCA", "Selic", "Câmbio", "PIB Total", "IPCA 12M Suavizado"]


def test_expectations_fact(spark):
    fact = facts.expectations_fact(survey(
        spark, ("IPCA", None, 0, 1.5), ("IPCA", "x", 1, 1.5), ("IPCA", "y", 7, 1.5)))
    found = {r.indicador_detalhe: (r.base_calculo_desc, r.spread_min_max, r.data_sk)
             for r in fact.collect()}
    assert found == {"Geral": ("30 dias corridos", 1.55, 20240102),
                     "x": ("5 dias úteis", 1.55, 20240102), "y": ("Outro", 1.55, 20240102)}


@pytest.mark.parametrize("theirs, ours, signal, divergence", [
    (2.0, 1.5, facts.TOP5_ABOVE, 0.5), (1.0, 1.5, facts.TOP5_BELOW, -0.5),
    (1.5, 1.5, facts.TOP5_AGREES, 0.0), (None, 1.5, facts.TOP5_AGREES, None),
    (1.5, None, facts.TOP5_AGREES, None)])
def test_position_signal(spark, theirs, ours, signal, divergence):
    row = facts.market_vs_top5_fact(
        survey(spark, ("IPCA", None, 1, ours)), top5(spark, ("IPCA", "C", theirs))).first()
    assert (row.sinal_posicionamento, row.divergencia_top5_mercado) == (signal, divergence)


def test_comparison_keeps_only_base_1_type_c_and_common_keys(spark):
    fact = facts.market_vs_top5_fact(
        survey(spark, ("IPCA", None, 1, 1.0), ("IPCA", None, 0, 7.0), ("PIB Total", None, 1, 1.0)),
        top5(spark, ("IPCA", "C", 1.0), ("IPCA", "M", 7.0), ("Selic", "C", 1.0)))
    assert [(r.indicador, r.mediana_mercado) for r in fact.collect()] == [("IPCA", 1.0)]


def test_details_fan_out_and_are_counted_beforehand(spark):
    market = survey(spark, ("IPCA", None, 1, 1.0), ("IPCA", "x", 1, 2.0), ("Selic", None, 1, 3.0))
    assert facts.market_vs_top5_fact(market, top5(spark, ("IPCA", "C", 1.0))).count() == 2
    found = facts.surplus_join_rows(market).first()
    assert (found.keys_with_details, found.surplus_rows) == (1, 1)


def test_comparison_join_adds_at_most_one_exchange_per_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = facts.market_vs_top5_fact(
            survey(spark, ("IPCA", None, 1, 1.0)), top5(spark, ("IPCA", "C", 1.0))
        )._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and "SortMergeJoin" in plan


def test_hot_join_key_is_split_at_run_time(spark):
    """A third of all market rows on one key: the join still spreads them over several tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") < 40000, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))

        def survey_of(ids):
            return ids.select(
                F.date_add(F.lit(DAY), F.length(key) % 2).alias("data"), key.alias("indicador"),
                F.col("id").cast("string").alias("indicador_detalhe"),
                F.lit(2026).alias("ano_referencia"), F.lit(1).alias("base_calculo"),
                F.lit("C").alias("tipo_calculo"),
                *[F.rand(7).alias(c) for c in ("media", "mediana", "desvio_padrao", "minimo", "maximo")],
                F.lit(1).alias("numero_respondentes"))

        market = survey_of(spark.range(0, 120000, numPartitions=8))
        panel = survey_of(spark.range(39999, 120000, numPartitions=8))
        fact = facts.market_vs_top5_fact(market, panel)
        assert len(fact.collect()) == 120000
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_real_rate_fact(spark):
    rate = spark.createDataFrame(
        [(DAY, 13.75), (date(2024, 1, 3), 10.0), (date(2024, 1, 4), 10.0)], "data date, taxa_selic_meta_aa double")
    inflation = spark.createDataFrame(
        [(DAY, 1, 4.65, 0.1), (DAY, 0, 9.0, 0.1), (date(2024, 1, 3), 1, -100.0, 0.1)],
        "data date, base_calculo int, mediana double, desvio_padrao double")
    found = {r.data: r.taxa_juro_real_ex_ante for r in facts.real_rate_fact(rate, inflation).collect()}
    assert found == {DAY: 8.6957, date(2024, 1, 3): None}


def test_newest_rows_is_a_bounded_sort(spark):
    frame = spark.range(100).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("data"))
    top = facts.newest_rows(frame, 3)
    assert [r.data.day for r in top.collect()] == [10, 9, 8]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_dimension_filter_reaches_the_fact(spark):
    fact = spark.createDataFrame([("IPCA", 1), ("Selic", 2), (None, 3)], "indicador string, v int")
    dim = dims.indicators(spark).filter("indicador_id = 2")
    assert [r.v for r in dims.restricted(fact, dim, "indicador").collect()] == [2]
    joined = dims.with_dimension(fact, dim, "indicador", ["unidade_medida"])
    assert {(r.v, r.unidade_medida) for r in joined.collect()} == {(1, None), (2, "% a.a."), (3, None)}


# ------------------------------------------------------------- data tests

def test_catalog_declares_all_tests():
    kinds = [t.test for t in catalog.DATA_TESTS]
    assert len(kinds) == 29
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("relationships")) == (22, 4, 3)


def test_each_kind_of_test_finds_its_failures(spark):
    tables = {
        "child": spark.createDataFrame([(1, "a"), (1, None), (7, "b"), (7, "b"), (None, "c")], "k int, v string"),
        "parent": spark.createDataFrame([(1,), (2,)], "k int"),
    }
    tests = [ColumnTest("child", "k", "not_null"), ColumnTest("child", "v", "not_null"),
             ColumnTest("child", "k", "unique"), ColumnTest("parent", "k", "unique"),
             ColumnTest("child", "k", "relationships", "parent", "k")]
    found = {(r.table_name, r.column_name, r.test): r.failures
             for r in checks.run_tests(tables, tests).collect()}
    assert found == {("child", "k", "not_null"): 1, ("child", "v", "not_null"): 1,
                     ("child", "k", "unique"): 2, ("parent", "k", "unique"): 0,
                     ("child", "k", "relationships"): 2}
    assert checks.failed_tests(checks.run_tests(tables, tests)).count() == 4
