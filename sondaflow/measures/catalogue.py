"""The forty measures by name.

A measure is called with the star, the columns to group by and a context, and
returns those columns and its value. Series measures need ``data`` among the
columns; the other columns name the series. ``measures`` evaluates any set of them as
one plan. What does not filter a measure, as the calendar where it is dropped or a column
of another fact, leaves its value the same for all groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.functions.dates import day_month_year
from sondaflow.functions.numbers import blank_minus, divergence_colour, table_colour
from sondaflow.functions.text import bold_digits, currency_label, percent_label
from sondaflow.measures import shapes
from sondaflow.measures.context import EVERYTHING, Context, Star, dimension_columns, inside, rows_in
from sondaflow.measures.sets import Piece, Recipe, evaluated
from sondaflow.measures.spread import calendar_columns, owned, reaching, spread

# Fixed values of the report: the projected year and the computation base of the cards.
CARD_YEAR = 2026
CARD_BASE = 0
LATEST_PREFIX = "Data da observação mais recente: "


@dataclass(frozen=True)
class Cards:
    """The year and base that the card measures fix."""

    year: int = CARD_YEAR
    base: int = CARD_BASE


def _grouped(star: Star, fact: str, by: list[str], context: Context) -> DataFrame:
    return dimension_columns(star, rows_in(star, fact, context), by)


def _series_of(by: list[str]) -> list[str]:
    if "data" not in by:
        raise ValueError("a measure along dates needs data among its columns")
    return [c for c in by if c != "data"]


class Kind:
    """How a measure is evaluated. Measures of equal ``batch`` share one aggregate."""

    def batch(self) -> tuple:
        return (self,)

    def together(self, star: Star, named: dict[str, "Kind"], by: list[str], context: Context,
                 cards: Cards) -> DataFrame:
        raise TypeError

    def recipe(self) -> Recipe:
        """What the measure is made of in a set; without pieces it is evaluated apart."""
        return Recipe()


@dataclass(frozen=True)
class Average(Kind):
    """An average, or what is shown of it."""

    fact: str
    column: str
    show: Callable[[Column], Column] = lambda value: value

    def batch(self) -> tuple:
        return type(self), self.fact

    def together(self, star, named, by, context, cards):
        means = shapes.averages(_grouped(star, self.fact, by, context), by,
                                {f"_{c}": c for c in dict.fromkeys(k.column for k in named.values())})
        return means.select(*by, *[k.show(F.col(f"_{k.column}")).alias(n) for n, k in named.items()])

    def recipe(self):
        piece = Piece(self.fact, "mean", self.column)
        return Recipe((piece,), lambda by: self.show(F.col(piece.name)), shows=self.show is not divergence_colour)


@dataclass(frozen=True)
class Selected(Average):
    """The value where there is only one."""

    def together(self, star, named, by, context, cards):
        return shapes.single_values(_grouped(star, self.fact, by, context), by, {n: k.column for n, k in named.items()})

    def recipe(self):
        piece = Piece(self.fact, "single", self.column)
        return Recipe((piece,), lambda by: F.col(piece.name))


@dataclass(frozen=True)
class Point(Average):
    """The value (or its label) on the last date of each series, null on its other dates."""

    def together(self, star, named, by, context, cards):
        series = _series_of(by)
        columns = dict.fromkeys(k.column for k in named.values())
        daily = shapes.by_date(_grouped(star, self.fact, by, context), series, {f"_{c}": c for c in columns})
        return daily.select(*by, *[k.show(shapes.last_point(series, f"_{k.column}")).alias(n) for n, k in named.items()])

    def recipe(self):
        piece = Piece(self.fact, "mean", self.column)
        return Recipe((piece,), lambda by: self.show(shapes.last_point(_series_of(by), piece.name)))


@dataclass(frozen=True)
class Highlight(Kind):
    """Start of the highlight, or the part of the series before or after it."""

    part: str

    def batch(self) -> tuple:
        return (type(self),)

    def together(self, star, named, by, context, cards):
        series = _series_of(by)
        daily = shapes.by_date(_grouped(star, "expectations", by, context), series, {"_value": "mediana"})
        split = shapes.with_highlight(daily, series, "_value", "highlight_start", "median_history", "median_recent")
        return split.select(*by, *[F.col(k.part).alias(n) for n, k in named.items()])

    def recipe(self):
        return Recipe((Piece("expectations", "mean", "mediana"),), highlight=self.part)


def _spread(groups: DataFrame, found: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """Each group with the values found for these columns of it, nulls included; without columns there
    is one row of values, which is a scalar."""
    if not columns:
        value = found.select(F.struct(*names)).scalar()
        return groups.withColumn("_found", value).select("*", *[f"_found.{n}" for n in names]).drop("_found")
    renamed = found.select(*[F.col(c).alias(f"_of_{c}") for c in columns], *names)
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    return groups.join(renamed, on).drop(*[f"_of_{c}" for c in columns])


@dataclass(frozen=True)
class Card(Kind):
    """An indicator's value on its own last date, for the card year (and base).

    The fixed columns replace the context's filters on them, and a group by one of them too:
    all its groups show the value. The indicator is a shared dimension, whose groups still filter.
    """

    fact: str
    column: str
    indicator: str

    def batch(self) -> tuple:
        return type(self), self.fact

    def fixed(self, cards: Cards) -> dict[str, Column]:
        columns = {"ano_referencia": F.col("ano_referencia") == cards.year}
        return columns | {"base_calculo": F.col("base_calculo") == cards.base} if self.fact == "expectations" else columns

    def together(self, star, named, by, context, cards):
        """The measure drops the calendar, so every day and month shows the same value."""
        fixed, every = self.fixed(cards), by
        by = [c for c in by if c not in calendar_columns(star, by)]
        mine = F.col("indicador").isin(*(k.indicator for k in named.values()))
        kept = [c for c in by if c not in fixed]
        narrowed = context.without_calendar().fixing(self.fact, {**fixed, "indicador": mine})
        rows = dimension_columns(star, rows_in(star, self.fact, narrowed), kept).withColumn("_card", F.col("indicador"))
        counts = shapes.is_filled(F.col(self.column)) if self.fact == "expectations" else None
        found = shapes.as_of_own_last_date(rows, [*kept, "_card"], {"_value": self.column}, counts)
        found = found.groupBy(*kept).agg(*[
            F.max(F.when(F.col("_card") == k.indicator, F.col("_value"))).alias(n) for n, k in named.items()])
        if len(kept) < len(by):
            groups = _grouped(star, self.fact, by, context).select(*by).distinct()
            found = _spread(groups, found, kept, list(named))
        return spread(found, by, dict.fromkeys(every), star, context).select(*every, *named)


@dataclass(frozen=True)
class OnLastDate(Average):
    """Average on the last date of the whole fact; groups without a row that day are absent (blank)."""

    def together(self, star, named, by, context, cards):
        rows = shapes.on_last_date_of(_grouped(star, self.fact, by, context), getattr(star, self.fact))
        return shapes.averages(rows, by, {n: k.column for n, k in named.items()})

    def recipe(self):
        piece = Piece(self.fact, "last", self.column)
        return Recipe((piece,), lambda by: F.col(piece.name))


@dataclass(frozen=True)
class CurrentRate(Average):
    """Average on the last date without calendar filters; the rows averaged still obey them.
    Groups by the fact's own columns have a last date each, groups by the calendar have not."""

    def together(self, star, named, by, context, cards):
        rows, within = inside(star, self.fact, context)
        own = [c for c in by if c not in calendar_columns(star, by)]
        return shapes.as_of_last_date_of(
            dimension_columns(star, rows, by), by, own, {n: k.column for n, k in named.items()}, within)

    def recipe(self):
        return Recipe()


@dataclass(frozen=True)
class Alone(Kind):
    """A measure of its own kind, over the rows of ``fact`` where a set evaluates it apart."""

    evaluate: Callable[[Star, list[str], Context], DataFrame]
    made_of: Recipe = Recipe()
    fact: str = "expectations"

    def together(self, star, named, by, context, cards):
        return self.evaluate(star, by, context)

    def recipe(self):
        return self.made_of


@dataclass(frozen=True)
class Measure:
    number: int
    kind: Kind


TOP5_MEAN, MARKET_MEAN = Piece("comparison", "mean", "mediana_top5"), Piece("expectations", "mean", "mediana")
LAST_SPREAD = Piece("comparison", "last", "divergencia_top5_mercado")
DIFFERENCE = Recipe((TOP5_MEAN, MARKET_MEAN), lambda by: blank_minus(F.col(TOP5_MEAN.name), F.col(MARKET_MEAN.name)))
LAST_SIGN = Recipe((LAST_SPREAD,), lambda by: table_colour(F.col(LAST_SPREAD.name)), shows=False)


def divergence(star: Star, by: list[str], context: Context) -> DataFrame:
    """Top 5 median minus market median, each over its own fact. The shared dimensions reach both facts;
    a column of one fact (``fact.column`` where both have one) filters that fact only, and the other's
    median stands beside each of its groups."""
    if all(c in star.indicators.columns or c in star.calendar.columns for c in by):
        return shapes.mean_difference(
            _grouped(star, "comparison", by, context), "mediana_top5",
            _grouped(star, "expectations", by, context), "mediana", by, "divergence")
    return evaluated(star, {"divergence": DIFFERENCE}, [], owned(star, by, ["comparison", "expectations"]), context)


def last_survey_date(star: Star, by: list[str], context: Context) -> DataFrame:
    """The filter on the calendar's date is dropped: a date as a group shows the last one of its other groups."""
    kept = [c for c in by if c not in ("data", "data_sk")]
    rows = _grouped(star, "expectations", kept, context.without_day())
    found = rows.groupBy(*kept).agg(F.max("data").alias("last_survey_date"))
    return spread(found, kept, dict.fromkeys(by), star, context).select(*by, "last_survey_date")


def last_median(star: Star, by: list[str], context: Context) -> DataFrame:
    """The measure drops the calendar, so every day and month shows the same value."""
    kept = [c for c in by if c not in calendar_columns(star, by)]
    rows = _grouped(star, "expectations", kept, context.without_calendar())
    found = shapes.filled_last_date(rows, kept, "mediana", "kpi_last_median").drop("data")
    return spread(found, kept, dict.fromkeys(by), star, context).select(*by, "kpi_last_median")


def table_sign(star: Star, by: list[str], context: Context) -> DataFrame:
    """Three-way colour; a group that is blank on the last date still has the neutral one."""
    rows = _grouped(star, "comparison", by, context)
    last = star.comparison.agg(F.max("data")).scalar()
    spread = rows.withColumn(
        "_spread", F.when(F.col("data") == last, F.col("divergencia_top5_mercado")))
    return shapes.averages(spread, by, {"_spread": "_spread"}).select(
        *by, table_colour(F.col("_spread")).alias("table_colour"))


def latest_text(star: Star, by: list[str] | None = None,
                context: Context = EVERYTHING) -> DataFrame:
    """The newest observation in words: the rate fact decides, then the comparison, then the survey.
    Every filter and group is ignored."""
    dates = [fact.agg(F.max("data")).scalar()
             for fact in (star.real_rate, star.comparison, star.expectations) if fact is not None]
    one = star.calendar.sparkSession.range(1)
    text = F.concat(F.lit(LATEST_PREFIX), bold_digits(day_month_year(F.coalesce(*dates))))
    return one.select(text.alias("latest_text"))


MEASURES: dict[str, Measure] = {
    "median_market": Measure(1, Average("expectations", "mediana")),
    "median_top5": Measure(2, Average("comparison", "mediana_top5")),
    "divergence": Measure(3, Alone(divergence, DIFFERENCE)),
    "real_rate": Measure(4, Selected("real_rate", "taxa_juro_real_ex_ante")),
    "policy_rate": Measure(5, Selected("real_rate", "taxa_selic_meta_aa")),
    "last_percent_label": Measure(6, Point("expectations", "mediana", percent_label)),
    "highlight_start": Measure(7, Highlight("highlight_start")),
    "median_history": Measure(8, Highlight("median_history")),
    "median_recent": Measure(9, Highlight("median_recent")),
    "last_currency_label": Measure(10, Point("expectations", "mediana", currency_label)),
    "last_point": Measure(11, Point("expectations", "mediana")),
    "last_survey_date": Measure(12, Alone(last_survey_date)),
    "kpi_last_median": Measure(13, Alone(last_median)),
    "kpi_ipca": Measure(14, Card("expectations", "mediana", "IPCA")),
    "kpi_selic": Measure(15, Card("expectations", "mediana", "Selic")),
    "kpi_pib": Measure(16, Card("expectations", "mediana", "PIB Total")),
    "kpi_dolar": Measure(17, Card("expectations", "mediana", "Câmbio")),
    "comparison_market": Measure(18, Average("comparison", "mediana_mercado")),
    "top5_label": Measure(19, Point("comparison", "mediana_top5", percent_label)),
    "market_label": Measure(20, Point("comparison", "mediana_mercado", percent_label)),
    "top5_point": Measure(21, Point("comparison", "mediana_top5")),
    "market_point": Measure(22, Point("comparison", "mediana_mercado")),
    "spread": Measure(23, Average("comparison", "divergencia_top5_mercado")),
    "divergence_colour": Measure(24, Average("comparison", "divergencia_top5_mercado", divergence_colour)),
    "kpi_divergence_ipca": Measure(25, Card("comparison", "divergencia_top5_mercado", "IPCA")),
    "kpi_divergence_selic": Measure(26, Card("comparison", "divergencia_top5_mercado", "Selic")),
    "market_last_date": Measure(27, OnLastDate("comparison", "mediana_mercado")),
    "top5_last_date": Measure(28, OnLastDate("comparison", "mediana_top5")),
    "divergence_last_date": Measure(29, OnLastDate("comparison", "divergencia_top5_mercado")),
    "table_colour": Measure(30, Alone(table_sign, LAST_SIGN)),
    "kpi_policy_rate": Measure(31, CurrentRate("real_rate", "taxa_selic_meta_aa")),
    "kpi_inflation": Measure(32, CurrentRate("real_rate", "ipca_esperado_12m")),
    "kpi_real_rate": Measure(33, CurrentRate("real_rate", "taxa_juro_real_ex_ante")),
    "real_rate_history": Measure(34, Average("real_rate", "taxa_juro_real_ex_ante")),
    "real_rate_point": Measure(35, Point("real_rate", "taxa_juro_real_ex_ante")),
    "policy_rate_history": Measure(36, Average("real_rate", "taxa_selic_meta_aa")),
    "policy_rate_point": Measure(37, Point("real_rate", "taxa_selic_meta_aa")),
    "inflation_history": Measure(38, Average("real_rate", "ipca_esperado_12m")),
    "inflation_point": Measure(39, Point("real_rate", "ipca_esperado_12m")),
    "latest_text": Measure(40, Alone(latest_text)),
}


def measures(names: list[str], star: Star, by: list[str] | None = None, context: Context = EVERYTHING,
             cards: Cards = Cards(), shown: list[str] | None = None) -> DataFrame:
    """Several measures beside their groups.

    Measures of one kind over one fact are one aggregate and keep all groups of the fact. Any other set,
    and one with ``shown``, is planned as ``sets`` says; groups in which all of ``shown`` are blank (by
    default all measures but colours) are left out.
    """
    named, by = {n: MEASURES[n].kind for n in names}, by or []
    if shown is None and len({k.batch() for k in named.values()}) == 1:
        return named[names[0]].together(star, named, by, context, cards)
    text = [n for n in names if n == "latest_text"]
    recipes = {n: k.recipe() for n, k in named.items() if n not in text}
    if not recipes:
        raise ValueError("the newest observation has no groups to be shown in")
    facts = dict.fromkeys(p.fact for r in recipes.values() for p in r.pieces)
    alone: dict[tuple, dict[str, Kind]] = {}
    for n, recipe in recipes.items():
        if not recipe.pieces:
            alone.setdefault(named[n].batch(), {})[n] = named[n]
            facts[named[n].fact] = None
    owners = owned(star, by, list(facts))
    apart = []
    for few in alone.values():
        first = next(iter(few.values()))
        keys = reaching(star, first.fact, owners)
        apart.append(spread(first.together(star, few, keys, context, cards), keys, owners, star, context))
    found = evaluated(star, recipes, apart, owners, context, shown)
    return found.withColumn("latest_text", latest_text(star).scalar()) if text else found


def measure(name: str, star: Star, by: list[str] | None = None,
            context: Context = EVERYTHING, cards: Cards = Cards()) -> DataFrame:
    """Evaluate one measure."""
    return measures([name], star, by, context, cards)
