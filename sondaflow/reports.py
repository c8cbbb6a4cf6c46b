"""The three report pages. All charts of a page come from one plan over its fact; all cards
of a page from one aggregate. Rows whose measures are all blank are not shown."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from sondaflow.functions.dates import trailing_months
from sondaflow.functions.numbers import divergence_colour
from sondaflow.functions.text import currency_thousands, percent_label, signed_points
from sondaflow.measures import shapes
from sondaflow.measures.catalogue import CARD_BASE, CARD_YEAR, latest_text, measures
from sondaflow.measures.context import Context, Star

CHART_MONTHS = 6
CURRENCY = "Câmbio"

OVERVIEW_CHART = ["median_history", "median_recent", "last_point"]
COMPARISON_MEANS = ["median_top5", "comparison_market", "spread"]
COMPARISON_POINTS = ["top5_point", "market_point"]
TABLE_MEANS = ["market_last_date", "top5_last_date", "divergence_last_date"]
RATE_COLUMNS = {"real_rate": "taxa_juro_real_ex_ante", "inflation": "ipca_esperado_12m",
                "policy_rate": "taxa_selic_meta_aa"}


def _only(rows: DataFrame, column: str, members: list | None) -> DataFrame:
    """An IN filter; no list means the visual does not filter that column."""
    return rows if members is None else rows.filter(F.col(column).isin(members))


def _chart_context(fact: str, as_of: date, indicators: list[str] | None, months: int, **fixed: int) -> Context:
    """The filters of a chart: its last months, the values it fixes, its list of indicators."""
    filters = {c: F.col(c) == value for c, value in fixed.items()}
    filters["data"] = trailing_months(F.col("data"), as_of, months)
    if indicators is not None:
        filters["indicador"] = F.col("indicador").isin(indicators)
    return Context(facts={fact: filters})


# --------------------------------------------------------- page 1: overview

def overview_charts(star: Star, as_of: date, indicators: list[str] | None = None,
                    year: int = CARD_YEAR, base: int = CARD_BASE,
                    months: int = CHART_MONTHS) -> DataFrame:
    """History, recent part and last point of every indicator's projection for one year."""
    context = _chart_context("expectations", as_of, indicators, months, ano_referencia=year, base_calculo=base)
    chart = measures([*OVERVIEW_CHART, "last_percent_label", "last_currency_label"], star, ["indicador", "data"],
                     context, shown=OVERVIEW_CHART)
    text = F.when(F.col("indicador") == CURRENCY, F.col("last_currency_label")).otherwise(F.col("last_percent_label"))
    return chart.select("indicador", "data", *OVERVIEW_CHART, text.alias("last_label")).orderBy("indicador", "data")


def overview_cards(star: Star, indicators: list[str] | None = None,
                   year: int = CARD_YEAR, base: int = CARD_BASE) -> DataFrame:
    """The latest median of each indicator: one aggregate, one row per card."""
    rows = _only(star.expectations, "indicador", indicators).filter(
        (F.col("ano_referencia") == year) & (F.col("base_calculo") == base))
    cards = shapes.filled_last_date(rows, ["indicador"], "mediana", "last_median")
    value = F.col("last_median")
    text = F.when(F.col("indicador") == CURRENCY, currency_thousands(value)).otherwise(
        percent_label(value))
    return cards.select("indicador", "data", "last_median", text.alias("card_text"))


# ------------------------------------------------- page 2: Top 5 comparison

def comparison_charts(star: Star, as_of: date, indicators: list[str] | None = None,
                      year: int = CARD_YEAR, months: int = CHART_MONTHS) -> DataFrame:
    """Top 5 beside market by date with the pointers and labels of their last dates."""
    context = _chart_context("comparison", as_of, indicators, months, ano_referencia=year)
    return measures([*COMPARISON_MEANS, *COMPARISON_POINTS, "top5_label", "market_label"], star, ["indicador", "data"],
                    context, shown=["median_top5", "comparison_market", *COMPARISON_POINTS]).orderBy("indicador", "data")


def divergence_columns(star: Star, as_of: date, indicators: list[str] | None = None,
                       year: int = CARD_YEAR, months: int = CHART_MONTHS) -> DataFrame:
    """Mean divergence by date with the colour of its sign."""
    rows = _only(star.comparison, "indicador", indicators).filter(
        (F.col("ano_referencia") == year) & trailing_months(F.col("data"), as_of, months))
    daily = shapes.by_date(rows, ["indicador"], {"spread": "divergencia_top5_mercado"})
    return shapes.shown(daily, ["spread"]).withColumn(
        "divergence_colour", divergence_colour(F.col("spread"))).orderBy("indicador", "data")


def comparison_table(star: Star) -> DataFrame:
    """Indicator, year and signal on the last date of the whole comparison, without any filter."""
    return measures([*TABLE_MEANS, "table_colour"], star, ["indicador", "ano_referencia", "sinal_posicionamento"],
                    shown=TABLE_MEANS).orderBy("ano_referencia")


def divergence_cards(star: Star, indicators: list[str] | None = None,
                     year: int = CARD_YEAR) -> DataFrame:
    """Each indicator's divergence on its own last date."""
    rows = _only(star.comparison, "indicador", indicators).filter(F.col("ano_referencia") == year)
    cards = shapes.as_of_own_last_date(
        rows, ["indicador"], {"kpi_divergence": "divergencia_top5_mercado"})
    return cards.withColumn("card_text", signed_points(F.col("kpi_divergence")))


# ------------------------------------------------------- page 3: real rates

def rate_charts(star: Star, as_of: date, months: int = CHART_MONTHS) -> DataFrame:
    """Real rate, expected inflation and policy rate by date, each with its pointer."""
    rows = star.real_rate.filter(trailing_months(F.col("data"), as_of, months))
    daily = shapes.by_date(rows, [], RATE_COLUMNS)
    chart = shapes.with_last_points(daily, [], {f"{name}_point": name for name in RATE_COLUMNS})
    return shapes.shown(chart, list(RATE_COLUMNS)).orderBy("data")


def rate_cards(star: Star) -> DataFrame:
    """The three rates on the last date of the rate fact."""
    latest = shapes.on_last_date_of(star.real_rate, star.real_rate)
    cards = shapes.averages(latest, [], {f"kpi_{name}": c for name, c in RATE_COLUMNS.items()})
    return cards.withColumns({f"text_{name}": percent_label(F.col(f"kpi_{name}"))
                              for name in RATE_COLUMNS})


def latest_observation(star: Star) -> DataFrame:
    return latest_text(star)
