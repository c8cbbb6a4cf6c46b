"""The registered queries. Each takes a session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sondaflow import reports
from sondaflow.functions.dates import date_key
from sondaflow.functions.text import currency_label, currency_thousands, percent_label, signed_points
from sondaflow.measures import shapes
from sondaflow.measures.catalogue import Cards, measure, measures
from sondaflow.measures.context import Context
from sondaflow.operators import checks, dims, facts, gates
from sondaflow.operators.curate import BATCH, INGESTED, RAW_BATCH, RAW_INGESTED, typed
from sondaflow.plans import catalog, run
from sondaflow.session import scratch_path
from sondaflow.sources import landing, paged
from sondaflow.sources.tables import TableSink
from workload import marts, proxies
from workload.means import DIGITS, MEANS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Days on which the reports are read; parameters, so that results can be compared.
LINES_AS_OF = date(2001, 11, 30)
NEWS_AS_OF = date(2024, 1, 31)
RATES_AS_OF = date(2001, 8, 1)
LINES_YEAR = 2002
NEWS_CARDS = ["IPCA", "Selic", "PIB Total", "Câmbio"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _sink(spark: SparkSession, label: str) -> TableSink:
    """A database of its own for queries that write tables."""
    path = scratch_path(spark, label)
    return TableSink(spark, path.rsplit("/", 1)[1].replace("-", "_"), path).create()


# ------------------------------------------------------------- curation

@query
def curated_survey(spark, folder):
    """Contract projection and deduplication, few keys with many records each."""
    return marts.curated_news(spark, folder).drop(RAW_BATCH)


@query
def curated_panel(spark, folder):
    """The same on many keys."""
    return marts.curated_panel(spark, folder).drop(RAW_BATCH, RAW_INGESTED)


@query
def curated_market(spark, folder):
    """Natural key with a part that may be null."""
    return marts.curated_market(spark, folder).drop(RAW_BATCH, RAW_INGESTED)


@query
def curated_rate(spark, folder):
    """Text dates and text numbers; ties on the load time are broken by the value."""
    return marts.curated_rate(spark, folder).drop(RAW_BATCH, RAW_INGESTED)


@query
def curated_inflation(spark, folder):
    return marts.curated_inflation(spark, folder).drop(RAW_BATCH, RAW_INGESTED)


@query
def typed_flawed_survey(spark, folder):
    """What damaged text becomes: conversion gives null and never an error."""
    return typed(proxies.flawed_news(spark, folder), proxies.SURVEY_SPEC).select(
        "data", "indicador", "ano_referencia", "mediana", "maximo", "numero_respondentes")


# ---------------------------------------------------------------- gates

def _metrics(counts: DataFrame) -> DataFrame:
    return counts.select(F.concat_ws("__", "kind", F.nullif("name", F.lit(""))).alias("metric"), "violations")


@query
def gate_metrics(spark, folder):
    """Conversions, keys and rules in one aggregate, on damaged records."""
    flawed = proxies.flawed_news(spark, folder)
    return _metrics(gates.curation_metrics(flawed, proxies.SURVEY_SPEC))


@query
def gate_metrics_clean(spark, folder):
    return _metrics(gates.curation_metrics(
        proxies.market(spark, folder), proxies.SURVEY_SPEC))


def _load_spec(table: str):
    return next(s for s in catalog.SOURCES if s.target == catalog.raw_table(table))


@query
def duplicate_keys(spark, folder):
    """Rows, newest date and surplus rows per natural key of a load."""
    return gates.load_metrics(proxies.market(spark, folder), _load_spec(catalog.SURVEY))


@query
def freshness_gate(spark, folder):
    """Newest date and age of three loads against the allowed age."""
    loads = {catalog.SURVEY: proxies.news(spark, folder), catalog.TOP5: proxies.news_panel(spark, folder),
             catalog.RATE: proxies.rate(spark, folder)}
    parts = []
    for table, raw in loads.items():
        spec = replace(_load_spec(table), keys=())
        metrics = gates.freshness(gates.load_metrics(raw, spec), NEWS_AS_OF, spec.max_age_days)
        parts.append(metrics.select(F.lit(table).alias("source"), "rows", "newest", "age_days", "fresh"))
    return reduce(DataFrame.unionByName, parts)


@query
def volume_gate(spark, folder):
    """A load of the open lines against all lines: too few, so it would be refused."""
    lines = proxies.table(spark, folder, "lineitem")
    return gates.volume(lines.filter("l_linestatus = 'O'"), lines, 0.90)


# --------------------------------------------------- dimensions and facts

@query
def calendar_coverage(spark, folder):
    """Every calendar day with its attributes and the orders that fall on it."""
    orders = proxies.table(spark, folder, "orders")
    per_day = orders.groupBy(date_key(F.col("o_orderdate")).alias("data_sk")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return dims.calendar(spark).join(per_day, "data_sk", "left").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0)))


@query
def calendar_rollup(spark, folder):
    """Lines by calendar attributes; counted per day first, so the join carries one row per day."""
    lines = proxies.table(spark, folder, "lineitem")
    per_day = lines.groupBy(date_key(F.col("l_shipdate")).alias("data_sk")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    names = ["ano", "trimestre", "semestre", "nome_mes", "dia_semana_nome", "flg_dia_util_teorico"]
    return dims.with_dimension(per_day, dims.calendar(spark), "data_sk", names).groupBy(*names).agg(
        F.sum("n").alias("n_lines"), F.sum("q").alias("quantity"))


@query
def indicator_profile(spark, folder):
    """Each indicator of the dimension with its survey rows; an indicator may have none."""
    survey = typed(proxies.news(spark, folder), proxies.SURVEY_SPEC)
    per_indicator = survey.groupBy("indicador").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ano_referencia").alias("n_years"))
    return dims.indicators(spark).join(per_indicator, "indicador", "left")


@query
def fact_expectations(spark, folder):
    return marts.market_fact(spark, folder)


@query
def fact_market_vs_top5(spark, folder):
    """Two curated tables joined on date, indicator and year; divergence and signal."""
    return marts.comparison_fact(spark, folder)


@query
def fact_market_vs_top5_news(spark, folder):
    """The same where each key has very many raw records."""
    return marts.news_comparison_fact(spark, folder)


@query
def fact_real_rate(spark, folder):
    return marts.real_rate_fact(spark, folder)


@query
def join_fan_out(spark, folder):
    """Market rows per comparison key beyond the first."""
    return facts.surplus_join_rows(marts.curated_market(spark, folder))


@query
def newest_comparison_rows(spark, folder):
    """The diagnostic top ten, ties broken by the rest of the row."""
    star = marts.lines(spark, folder, "comparison")
    return facts.newest_rows(star.comparison, 10, [
        "indicador", "ano_referencia", "mediana_mercado", "mediana_top5", "numero_respondentes",
        "desvio_padrao_mercado"])


@query
def newest_rate_rows(spark, folder):
    return facts.newest_rows(marts.lines(spark, folder, "real_rate").real_rate, 10)


@query
def newest_expectation_rows(spark, folder):
    star = marts.lines(spark, folder, "expectations")
    return facts.newest_rows(star.expectations, 10, [
        "indicador", "indicador_detalhe", "ano_referencia", "base_calculo"])


# ----------------------------------------------------------- data tests

@query
def test_not_null(spark, folder):
    """Null counts of typed damaged records."""
    flawed = typed(proxies.flawed_news(spark, folder), proxies.SURVEY_SPEC)
    return checks.not_null(flawed, "survey", ["data", "indicador", "ano_referencia", "mediana"])


@query
def test_unique(spark, folder):
    """The failing rows of a uniqueness test."""
    return checks.repeated_values(proxies.table(spark, folder, "lineitem"), "l_orderkey")


@query
def test_relationships(spark, folder):
    """Keys without a parent, in two tables whose keys only partly agree with the parent's."""
    child = {"events": ("user_id", "supplier", "s_suppkey"),
             "lineitem": ("l_partkey", "customer", "c_custkey")}
    parts = []
    for name, (column, parent, key) in child.items():
        found = checks.orphans(proxies.table(spark, folder, name), column,
                               proxies.table(spark, folder, parent), key)
        parts.append(found.select(F.lit(name).alias("table_name"),
                                  F.col(column).alias("orphan"), "rows"))
    return reduce(DataFrame.unionByName, parts)


@query
def data_tests(spark, folder):
    """All declared tests of the star, one row each."""
    star = marts.lines(spark, folder, "expectations", "comparison", "real_rate")
    tables = {catalog.CALENDAR: star.calendar, catalog.INDICATORS: star.indicators,
              catalog.EXPECTATIONS: star.expectations, catalog.COMPARISON: star.comparison,
              catalog.REAL_RATE: star.real_rate}
    return checks.run_tests(tables, list(catalog.DATA_TESTS))


# ------------------------------------------------------------- measures

@query
def median_by_series(spark, folder):
    star = marts.lines(spark, folder, "expectations")
    return measure("median_market", star, ["indicador", "ano_referencia"])


@query
def median_by_quarter(spark, folder):
    """Grouped by calendar attributes, filtered by one of them and by the indicator dimension."""
    star = marts.lines(spark, folder, "expectations")
    context = Context(calendar=F.col("flg_dia_util_teorico") == 1, indicator=F.col("indicador_id") > 1)
    return measure("median_market", star, ["ano", "trimestre"], context)


@query
def top5_by_series(spark, folder):
    """Averages of the comparison in one aggregate."""
    star = marts.lines(spark, folder, "comparison")
    return shapes.averages(star.comparison, ["indicador", "ano_referencia"], {
        "median_top5": "mediana_top5", "comparison_market": "mediana_mercado",
        "spread": "divergencia_top5_mercado"})


@query
def cross_fact_divergence(spark, folder):
    """Difference of measures of two facts by their shared dimensions; a side without rows is zero."""
    star = marts.lines(spark, folder, "expectations", "comparison")
    return measure("divergence", star, ["indicador", "ano", "semestre"])


@query
def single_values(spark, folder):
    star = marts.lines(spark, folder, "expectations")
    return shapes.single_values(star.expectations, ["indicador", "data", "ano_referencia"], {
        "single_median": "mediana", "single_base": "base_calculo"})


@query
def single_rates(spark, folder):
    """Rates of a day; of a weekday of a month only where it has a single value."""
    star = marts.lines(spark, folder, "real_rate")
    return measures(["real_rate", "policy_rate"], star, ["ano_mes", "dia_semana_nome"])


@query
def highlight_series(spark, folder):
    """History, recent part, last point and labels of every series in one plan."""
    star = marts.lines(spark, folder, "expectations")
    return _highlighted(star.expectations, ["indicador"])


@query
def highlight_news(spark, folder):
    """The same on series shorter than the highlight, which then starts at their first date."""
    star = marts.news(spark, folder, "expectations")
    return _highlighted(star.expectations, ["indicador", "ano_referencia", "base_calculo"])


def _highlighted(fact: DataFrame, series: list[str]) -> DataFrame:
    daily = shapes.by_date(fact, series, {"median_market": "mediana"})
    chart = shapes.with_highlight(daily, series, "median_market", "highlight_start",
                                  "median_history", "median_recent", "last_point")
    return chart.withColumns({"last_percent_label": percent_label(F.col("last_point")),
                              "last_currency_label": currency_label(F.col("last_point"))})


@query
def last_survey_date(spark, folder):
    """The date filter is dropped, the filter on the calendar's year stays."""
    star = marts.lines(spark, folder, "expectations")
    context = Context(days=(None, date(1996, 6, 30)), calendar=F.col("ano") <= 2000)
    return measure("last_survey_date", star, ["indicador"], context)


@query
def kpi_last_median(spark, folder):
    star = marts.lines(spark, folder, "expectations")
    return measure("kpi_last_median", star, ["indicador", "ano_referencia", "base_calculo"])


CARDS = (["kpi_ipca", "kpi_selic", "kpi_pib", "kpi_dolar"], ["kpi_divergence_ipca", "kpi_divergence_selic"],
         ["kpi_policy_rate", "kpi_inflation", "kpi_real_rate"])


@query
def measure_cards(spark, folder):
    """The nine card measures by name, without any filter of their own page: one aggregate per fact."""
    published = marts.news(spark, folder, "expectations", "comparison", "real_rate")
    cards = [measures(names, published).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in names])).alias("card")).select("card.*")
        for names in CARDS]
    return reduce(DataFrame.unionByName, cards)


@query
def cards_in_conflict(spark, folder):
    """Cards replace the filter on the year by their own, and all groups of it show their value."""
    star = marts.news(spark, folder, "expectations")
    later = Context(facts={"expectations": {"ano_referencia": F.col("ano_referencia") == 2027,
                                            "base_calculo": F.col("base_calculo") == 0}})
    parts = [("filtered", [], later), ("grouped", ["ano_referencia"], Context()), ("both", ["ano_referencia"], later)]
    found = [measures(CARDS[0], star, by, context, Cards(2025)).withColumn(
        "ano_referencia", F.col("ano_referencia") if by else F.lit(None).cast("int")).select(
        F.lit(label).alias("context"), "ano_referencia", *CARDS[0]) for label, by, context in parts]
    return reduce(DataFrame.unionByName, found)


@query
def divergence_cards_by_signal(spark, folder):
    """A group that the card does not fix still filters it."""
    return measures(CARDS[1], marts.news(spark, folder, "comparison"), ["ano_referencia", "sinal_posicionamento"])


@query
def rates_by_policy_rate(spark, folder):
    """Grouped by a column of the fact, each group has a last date of its own."""
    return measures(CARDS[2], marts.lines(spark, folder, "real_rate"), ["taxa_selic_meta_aa"])


@query
def rates_by_year(spark, folder):
    """Grouped by the calendar, the last date is that of the whole fact: other years are absent."""
    return measures(CARDS[2], marts.lines(spark, folder, "real_rate"), ["ano"])


@query
def medians_by_unit(spark, folder):
    """Both facts grouped by attributes of the indicator dimension."""
    star, by = marts.news(spark, folder, "expectations", "comparison"), ["unidade_medida", "periodicidade"]
    return measure("median_market", star, by).join(measure("divergence", star, by), by)


@query
def measure_set_by_quarter(spark, folder):
    """Measures of every kind over three facts beside each other: one scan of each fact for all of them."""
    star = marts.lines(spark, folder, "expectations", "comparison", "real_rate")
    return measures(["median_market", "median_top5", "divergence", "spread", "divergence_colour", "real_rate_history",
                     "policy_rate", "top5_last_date", "last_survey_date", "kpi_real_rate"], star, ["ano", "trimestre"])


@query
def calendar_free_by_month(spark, folder):
    """Cards drop the calendar, so every month of the context shows their value; the newest date of a month
    is the one it has, and days of it all show that."""
    star = marts.news(spark, folder, "expectations", "comparison")
    return measures(["kpi_ipca", "kpi_divergence_ipca", "last_survey_date", "median_market"], star, ["ano_mes"],
                    Context(calendar=F.col("ano") == 2024), Cards(2025))


@query
def newest_dates_by_day(spark, folder):
    """Grouped by the date that the measure drops, each day shows the last one of its month."""
    star = marts.news(spark, folder, "expectations")
    context = Context(days=(None, date(2024, 2, 10)), calendar=F.col("ano") == 2024)
    return measure("last_survey_date", star, ["indicador", "ano_mes", "data"], context)


@query
def divergence_by_signal(spark, folder):
    """The signal is a column of the comparison: the market's median is the same for all signals."""
    star = marts.lines(spark, folder, "expectations", "comparison")
    return measure("divergence", star, ["indicador", "sinal_posicionamento"])


@query
def divergence_by_owned_year(spark, folder):
    """Both facts have a year; the comparison's does not filter the market."""
    star = marts.news(spark, folder, "expectations", "comparison")
    return measures(["median_market", "median_top5", "divergence"], star, ["indicador", "comparison.ano_referencia"])


@query
def precise_means(spark, folder):
    """Averages of values with many digits and of very large ones."""
    orders = proxies.table(spark, folder, "orders").select(
        "o_orderpriority", (F.col("o_totalprice") / 7e9).alias("small"), (F.col("o_totalprice") * 1e11).alias("large"))
    return shapes.averages(orders, ["o_orderpriority"], {"mean_small": "small", "mean_large": "large"})


@query
def label_texts(spark, folder):
    """Labels of numbers of any size and sign."""
    lines = proxies.table(spark, folder, "lineitem")
    value = F.col("l_extendedprice") * F.pow(F.lit(10.0), F.col("l_linenumber") - 5) * F.when(
        F.col("l_returnflag") == "R", -1).otherwise(1)
    return lines.select("l_orderkey", "l_linenumber", percent_label(value).alias("percent"),
                        currency_thousands(value).alias("currency"), signed_points(value / 1e4).alias("points"))


@query
def news_points(spark, folder):
    """Pointers and labels by name, several in one aggregate."""
    return measures(["last_percent_label", "last_currency_label", "last_point"],
                    marts.news(spark, folder, "expectations"), ["indicador", "ano_referencia", "data"])


@query
def highlight_parts(spark, folder):
    return measures(["highlight_start", "median_history", "median_recent"],
                    marts.lines(spark, folder, "expectations"), ["indicador", "data"])


@query
def comparison_means(spark, folder):
    return measures(["median_top5", "comparison_market", "spread", "divergence_colour"],
                    marts.lines(spark, folder, "comparison"), ["indicador", "ano"])


@query
def comparison_points(spark, folder):
    return measures(["top5_label", "market_label", "top5_point", "market_point"],
                    marts.lines(spark, folder, "comparison"), ["indicador", "data"])


@query
def last_date_means(spark, folder):
    return measures(["market_last_date", "top5_last_date", "divergence_last_date"],
                    marts.lines(spark, folder, "comparison"), ["indicador", "ano_referencia"])


@query
def rate_histories(spark, folder):
    return measures(["real_rate_history", "policy_rate_history", "inflation_history"],
                    marts.lines(spark, folder, "real_rate"), ["ano", "mes"])


@query
def rate_points(spark, folder):
    return measures(["real_rate_point", "policy_rate_point", "inflation_point"],
                    marts.lines(spark, folder, "real_rate"), ["data"])


@query
def divergence_signs(spark, folder):
    star = marts.lines(spark, folder, "comparison")
    return measures(["spread", "divergence_colour"], star, ["indicador", "ano_referencia"])


@query
def kpi_divergence(spark, folder):
    """Divergence on the last date of each indicator and year."""
    star = marts.lines(spark, folder, "comparison")
    return shapes.as_of_own_last_date(star.comparison, ["indicador", "ano_referencia"], {
        "kpi_divergence": "divergencia_top5_mercado"})


@query
def last_date_colours(spark, folder):
    """Three-way colour on the global last date; indicators without a row that day are neutral."""
    return measure("table_colour", marts.lines(spark, folder, "comparison"), ["indicador"])


@query
def last_date_divergence(spark, folder):
    return measure("divergence_last_date", marts.lines(spark, folder, "comparison"),
                   ["indicador", "ano_referencia"])


@query
def rate_kpis_in_context(spark, folder):
    """The last date ignores the calendar filter, the average obeys it: blank when they disagree."""
    star = marts.lines(spark, folder, "real_rate")
    early, late = Context(days=(None, date(1999, 12, 31))), Context(calendar=F.col("ano") >= 2000)
    return measure("kpi_real_rate", star, [], early).select(
        F.lit("until 1999").alias("context"), "kpi_real_rate").unionByName(
        measure("kpi_real_rate", star, [], late).select(
            F.lit("since 2000").alias("context"), "kpi_real_rate"))


@query
def rate_series(spark, folder):
    """The whole history of the three rates with their pointers."""
    star = marts.lines(spark, folder, "real_rate")
    daily = shapes.by_date(star.real_rate, [], reports.RATE_COLUMNS)
    return shapes.with_last_points(daily, [], {f"{n}_point": n for n in reports.RATE_COLUMNS})


# -------------------------------------------------------------- reports

@query
def report_overview_charts(spark, folder):
    """Every line series of one year in one job."""
    star = marts.lines(spark, folder, "expectations")
    return reports.overview_charts(star, LINES_AS_OF, year=LINES_YEAR)


@query
def report_overview_charts_news(spark, folder):
    """The four indicators of the first page."""
    return reports.overview_charts(marts.news(spark, folder, "expectations"), NEWS_AS_OF, NEWS_CARDS)


@query
def report_overview_cards(spark, folder):
    return reports.overview_cards(marts.news(spark, folder, "expectations"), NEWS_CARDS)


@query
def report_comparison_charts(spark, folder):
    star = marts.lines(spark, folder, "comparison")
    return reports.comparison_charts(star, LINES_AS_OF, year=LINES_YEAR)


@query
def report_comparison_charts_news(spark, folder):
    return reports.comparison_charts(
        marts.news(spark, folder, "comparison"), NEWS_AS_OF, ["IPCA", "Selic"])


@query
def report_divergence_columns(spark, folder):
    return reports.divergence_columns(marts.news(spark, folder, "comparison"), NEWS_AS_OF, ["IPCA"])


@query
def report_comparison_table(spark, folder):
    return reports.comparison_table(marts.lines(spark, folder, "comparison"))


@query
def report_divergence_cards(spark, folder):
    return reports.divergence_cards(marts.news(spark, folder, "comparison"), ["IPCA", "Selic"])


@query
def report_rate_charts(spark, folder):
    return reports.rate_charts(marts.lines(spark, folder, "real_rate"), RATES_AS_OF)


@query
def report_rate_cards(spark, folder):
    return reports.rate_cards(marts.lines(spark, folder, "real_rate"))


@query
def report_latest_observation(spark, folder):
    star = marts.lines(spark, folder, "real_rate", "comparison", "expectations")
    return reports.latest_observation(star)


# -------------------------------------------------------- loads and runs

@query
def landed_survey(spark, folder):
    """Records written as JSON and read back with an inferred schema."""
    records = proxies.news(spark, folder).drop(BATCH, INGESTED)
    path = landing.land(landing.as_json(records), scratch_path(spark, "landed"))
    return landing.read_landed(spark, path)


@query
def page_layout(spark, folder):
    """Rows per page of the ordered events, which are numbered from 0."""
    events = proxies.table(spark, folder, "events")
    return events.groupBy(paged.page_number(F.col("event_id"), 1000).alias("page")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"))


@query
def window_counts(spark, folder):
    """One row per one-year date window with the lines shipped in it; the windows span all lines."""
    lines = proxies.table(spark, folder, "lineitem")
    ends = lines.agg(F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last")).first()
    windows = paged.date_windows(spark, ends.first, ends.last, 365)
    index = paged.window_index(F.col("first_day"), ends.first, 365)
    shipped = lines.groupBy(paged.window_index(F.col("l_shipdate"), ends.first, 365).alias("w")).agg(
        F.count(F.lit(1)).alias("n"))
    return windows.join(shipped, index == F.col("w"), "left").select(
        "first_day", "last_day", F.coalesce("n", F.lit(0)).alias("n_lines"))


def _landed(spark: SparkSession, folder: str, raw: dict[str, Query]) -> dict[str, dict[str, str]]:
    """The records of each raw table as JSON files; reader options by table."""
    def write(plan: Query) -> dict[str, str]:
        records = landing.as_json(plan(spark, folder).drop(BATCH, INGESTED))
        return {"path": landing.land(records, scratch_path(spark, "landed"))}

    with ThreadPoolExecutor(len(raw)) as pool:
        return dict(zip(raw, pool.map(write, raw.values())))


@query
def load_audit(spark, folder):
    """Four loads in one batch; the rate is stale and fails, the others are published."""
    raw = {catalog.SURVEY: proxies.news, catalog.TOP5: proxies.news_panel,
           catalog.INFLATION: proxies.inflation, catalog.RATE: proxies.rate}
    allowed = {catalog.INFLATION: 10_000}
    specs = [replace(_load_spec(t), reader="json", options=options,
                     max_age_days=allowed.get(t, 30))
             for t, options in _landed(spark, folder, raw).items()]
    sink = _sink(spark, "loads")
    run.ingest(sink, specs, NEWS_AS_OF)
    return sink.read(run.LOAD_AUDIT).select(
        "tabela", "status", "registros", "colunas", "data_max", "erro")


@query
def resumed_load(spark, folder):
    """Three loads whose driver is lost in the last one, and the same batch resumed: the last audit row of
    each table, and whether it was there before the resumption."""
    raw = {catalog.SURVEY: proxies.news, catalog.TOP5: proxies.news_panel, catalog.INFLATION: proxies.inflation}
    specs = [replace(_load_spec(t), reader="json", options=options, max_age_days=10_000)
             for t, options in _landed(spark, folder, raw).items()]

    def lost(session, spec):
        raise SystemExit("the driver is lost")

    sink = _sink(spark, "resumed")
    try:
        run.ingest(sink, [*specs[:2], replace(specs[2], reader="lost")], NEWS_AS_OF, "night", parallel=1,
                   readers={**landing.READERS, "lost": lost})
    except SystemExit:
        before = [r.tabela for r in sink.read(run.LOAD_AUDIT).collect()]
    run.ingest(sink, specs, NEWS_AS_OF, "night", resume=True).raise_failures()
    return run.newest_runs(sink.read(run.LOAD_AUDIT)).select(
        "tabela", "status", "registros", F.col("tabela").isin(before).alias("before"))


@query
def curation_audit(spark, folder):
    """Four curations in one batch; the damaged survey fails, the others are published."""
    sink = _sink(spark, "curations")
    raw = {catalog.SURVEY: proxies.flawed_news, catalog.TOP5: proxies.panel,
           catalog.INFLATION: proxies.inflation, catalog.RATE: proxies.rate}
    with ThreadPoolExecutor(len(raw)) as pool:
        list(pool.map(lambda t: sink.replace(raw[t](spark, folder), catalog.raw_table(t)), raw))
    run.curate_all(sink, list(catalog.CURATIONS))
    return sink.read(run.CURATION_AUDIT).select(
        "tabela", "status", "registros_lidos", "registros_gravados", "duplicatas_removidas", "erro")


@query
def refused_loads(spark, folder):
    """Published tables whose next load is empty, too small or lacks a column: what the audit of the
    second batch tells, what the batch raises at its end, and the rows that stay published."""
    sink, base = _sink(spark, "refused"), _load_spec(catalog.SURVEY)
    bad = {"empty": lambda rows: rows.filter("Mediana < 0 and Mediana > 0"),
           "short": lambda rows: rows.filter("baseCalculo = 0"),
           "narrow": lambda rows: rows.drop("Media")}
    good = _landed(spark, folder, {"all": proxies.news})["all"]
    landed = _landed(spark, folder, {n: lambda s, f, change=change: change(proxies.news(s, f)) for n, change in bad.items()})

    def specs(options: dict) -> list:
        return [replace(base, target=n, reader="json", options=options.get(n, good)) for n in bad]

    run.ingest(sink, specs({}), NEWS_AS_OF).raise_failures()
    batch = run.ingest(sink, specs(landed), NEWS_AS_OF, "second")
    try:
        batch.raise_failures()
        told = "nothing was refused"
    except run.BatchError as error:
        told = str(error)
    refused = run.failed_runs(sink.read(run.LOAD_AUDIT)).filter("batch_id = 'second'")
    kept = [sink.read(n).agg(F.lit(n).alias("tabela"), F.concat(F.count(F.lit(1)), F.lit(" rows")).alias("erro"))
            for n in bad]
    raised = spark.range(1).select(F.lit("batch").alias("tabela"), F.lit(told).alias("erro"))
    return reduce(DataFrame.unionByName, [refused.select("tabela", "erro"), raised, *kept])


@query
def refused_curation(spark, folder):
    """A raw table without two columns of the contract."""
    sink = _sink(spark, "contract")
    sink.replace(proxies.news(spark, folder).drop("Minimo", "Maximo"), catalog.raw_table(catalog.SURVEY))
    run.curate_all(sink, [c for c in catalog.CURATIONS if c.source == catalog.raw_table(catalog.SURVEY)])
    return sink.read(run.CURATION_AUDIT).select(
        "tabela", "status", "registros_lidos", "registros_gravados", "duplicatas_removidas", "erro")


@query
def replaced_and_widened(spark, folder):
    """A table replaced by one of another schema, then rows added that bring a column and lack one."""
    sink, orders = _sink(spark, "replaced"), proxies.table(spark, folder, "orders")
    sink.replace(orders.select("o_orderkey"), "prices")
    sink.replace(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), "prices")
    sink.append(orders.filter("o_orderstatus = 'O'").select("o_orderpriority", "o_orderkey"), "prices")
    return sink.read("prices")


# What a source would hold is written by Spark, a folder for each page or window; a transport reads the one it is asked for.

def _written_pages(rows: DataFrame, key: str, size: int) -> str:
    """The rows in the order of the key, one file per page: positions follow from the counts of ranges of the key."""
    spark = rows.sparkSession
    staged, root = scratch_path(spark, "ranges"), scratch_path(spark, "pages")
    rows.repartitionByRange(key).withColumn("__part", F.spark_partition_id()).write.parquet(staged)
    ranges = spark.read.parquet(staged)
    # A row per range of the key, a few hundred whatever the input.
    before, starts = 0, {}
    for r in ranges.groupBy("__part").count().orderBy("__part").collect():
        starts[r["__part"]], before = before, before + r["count"]
    counted = spark.createDataFrame(list(starts.items()), "__part int, __start long")
    place = F.row_number().over(Window.partitionBy("__part").orderBy(key)) - 1 + F.col("__start")
    (ranges.join(F.broadcast(counted), "__part").withColumn("page", paged.page_number(place, size))
     .drop("__part", "__start").repartition("page").sortWithinPartitions("page", key)
     .write.partitionBy("page").parquet(root))
    return root


def _reader() -> Callable[[str, list[str]], list[dict]]:
    """A function of its own, so that it travels with the job."""
    def read(folder: str, columns: list[str]) -> list[dict]:
        import pyarrow.parquet as parquet
        from pyarrow import fs
        system, path = fs.FileSystem.from_uri(folder)
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return []
        return parquet.read_table(path, columns=columns, filesystem=system, partitioning=None).to_pylist()
    return read


def _pages_of(root: str, columns: list[str]) -> Callable[[paged.PageRequest], list[dict]]:
    read = _reader()

    def fetch(request: paged.PageRequest) -> list[dict]:
        return read(f"{root}/page={request.skip // request.top}", columns)
    return fetch


def _windows_of(root: str, begin: date, days: int) -> Callable[[paged.WindowRequest], Iterator[dict]]:
    def fetch(request: paged.WindowRequest) -> Iterator[dict]:
        import pyarrow.parquet as parquet
        from pyarrow import fs
        system, path = fs.FileSystem.from_uri(f"{root}/window={(request.first - begin).days // days}")
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return
        for info in system.get_file_info(fs.FileSelector(path)):
            if info.path.endswith(".parquet"):
                with system.open_input_file(info.path) as source:
                    for batch in parquet.ParquetFile(source).iter_batches(10_000, columns=["o_orderkey", "o_orderdate", "o_totalprice"]):
                        for r in batch.to_pylist():
                            yield {**r, "o_orderdate": str(r["o_orderdate"])}
    return fetch


@query
def paged_events(spark, folder):
    """All events through the paged reader, three requests at a time."""
    columns = ["event_id", "user_id", "event_type", "value"]
    root = _written_pages(proxies.table(spark, folder, "events").select(*columns), "event_id", 1000)
    records = paged.read_pages(spark, _pages_of(root, columns), endpoint="events", order_by=("event_id",), page_size=1000, readers=3)
    schema = "event_id long, user_id long, event_type string, value double"
    return records.select(F.from_json("value", schema).alias("r")).select("r.*")


@query
def windowed_orders(spark, folder):
    """All orders through the windowed reader; the windows span the days that the orders have."""
    orders = proxies.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")
    ends = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")).first()
    root = scratch_path(spark, "windows")
    orders.withColumn("window", paged.window_index(F.col("o_orderdate"), ends.first, 365)).write.partitionBy("window").parquet(root)
    records = paged.read_windows(spark, _windows_of(root, ends.first, 365), series="orders",
                                 first=ends.first, last=ends.last, days=365)
    schema = "o_orderkey long, o_orderdate date, o_totalprice double"
    return records.select(F.from_json("value", schema).alias("r")).select("r.*")


_REFRESHED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _refreshed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Load, curate, model and test in one run, once per session: the published tables."""
    key = spark.sparkContext.applicationId, folder
    if key not in _REFRESHED:
        raw = {catalog.SURVEY: proxies.market, catalog.TOP5: proxies.panel,
               catalog.INFLATION: proxies.inflation, catalog.RATE: proxies.rate}
        sources = [replace(_load_spec(t), reader="json", options=options, max_age_days=365,
                           filter="tipoCalculo = 'C'" if t == catalog.TOP5 else None)
                   for t, options in _landed(spark, folder, raw).items()]
        _REFRESHED[key] = run.refresh(_sink(spark, "refreshed"), sources, list(catalog.CURATIONS), LINES_AS_OF)
    return _REFRESHED[key]


@query
def refreshed_tables(spark, folder):
    """Rows of each published fact."""
    tables = _refreshed(spark, folder)
    counts = [tables[name].select(F.lit(name).alias("table_name")).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows"))
        for name in (catalog.EXPECTATIONS, catalog.COMPARISON, catalog.REAL_RATE)]
    return reduce(DataFrame.unionByName, counts)


@query
def refreshed_expectations(spark, folder):
    return _refreshed(spark, folder)[catalog.EXPECTATIONS]


@query
def refreshed_comparison(spark, folder):
    return _refreshed(spark, folder)[catalog.COMPARISON]


@query
def refreshed_rates(spark, folder):
    return _refreshed(spark, folder)[catalog.REAL_RATE]


@query
def refreshed_tests(spark, folder):
    """The declared data tests on the tables of the run."""
    return checks.run_tests(_refreshed(spark, folder), list(catalog.DATA_TESTS))


def _nine_digits(plan: Query, columns: tuple[str, ...]) -> Query:
    return lambda spark, folder: plan(spark, folder).withColumns(
        {c: F.col(c) * float(DIGITS) - (F.col(c) * float(DIGITS) - F.col(c)) for c in columns})


for _name, _columns in MEANS.items():
    QUERIES[_name] = _nine_digits(QUERIES[_name], _columns)
