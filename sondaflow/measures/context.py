"""The star and the filter context a measure is evaluated in.

A context has two parts, because measures drop them separately: filters on the
calendar, and filters on everything else. Filters only ever flow from a
dimension to the facts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.operators.dims import restricted
from sondaflow.plans import catalog


FACTS = {"expectations", "comparison", "real_rate"}


@dataclass(frozen=True)
class Star:
    calendar: DataFrame
    indicators: DataFrame
    expectations: DataFrame | None = None
    comparison: DataFrame | None = None
    real_rate: DataFrame | None = None

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> "Star":
        return cls(tables[catalog.CALENDAR], tables[catalog.INDICATORS],
                   tables.get(catalog.EXPECTATIONS), tables.get(catalog.COMPARISON),
                   tables.get(catalog.REAL_RATE))


@dataclass(frozen=True)
class Context:
    """Filters in force.

    ``days``      inclusive range on the calendar's date; either end may be open
    ``calendar``  predicate on the calendar's other attributes
    ``indicator`` predicate on the indicator dimension
    ``facts``     filters on a fact's own columns, by the fact's name in ``Star``; they filter
                  that fact only. Given by column, ``{"expectations": {"ano_referencia": …}}``,
                  a measure that fixes the column replaces them; a bare predicate stays
    """

    days: tuple[date | None, date | None] | None = None
    calendar: Column | None = None
    indicator: Column | None = None
    facts: Mapping[str, Column | Mapping[str, Column]] = field(default_factory=dict)

    def without_day(self) -> "Context":
        """Only the filter on the calendar's date is removed; its other attributes still filter."""
        return replace(self, days=None)

    def without_calendar(self) -> "Context":
        return replace(self, days=None, calendar=None)

    def of_fact(self, fact: str) -> dict[str, Column]:
        """The fact's filters by column; one that is not given by column stands under no name."""
        given = self.facts.get(fact, {})
        return {"": given} if isinstance(given, Column) else dict(given)

    def and_fact(self, fact: str, predicate: Column) -> "Context":
        own = self.of_fact(fact)
        own[""] = own[""] & predicate if "" in own else predicate
        return replace(self, facts={**self.facts, fact: own})

    def fixing(self, fact: str, columns: Mapping[str, Column]) -> "Context":
        """Filters on these columns of the fact in place of those that were on them."""
        return replace(self, facts={**self.facts, fact: {**self.of_fact(fact), **columns}})


EVERYTHING = Context()


def rows_in(star: Star, name: str, context: Context = EVERYTHING) -> DataFrame:
    """The rows of a fact that the context leaves.

    A date range is put on the fact's own date column, where the file scan can
    use it; other calendar attributes come as a semi join on the date key, and
    the calendar is at most some fifteen thousand rows by construction.
    """
    unknown = set(context.facts) - FACTS
    if unknown:
        raise ValueError(f"no fact is called {sorted(unknown)}")
    fact = getattr(star, name)
    if fact is None:
        raise ValueError(f"the star was built without its {name} fact")
    rows = fact
    for predicate in context.of_fact(name).values():
        rows = rows.filter(predicate)
    if context.days is not None:
        first, last = context.days
        if first is not None:
            rows = rows.filter(F.col("data") >= F.lit(first))
        if last is not None:
            rows = rows.filter(F.col("data") <= F.lit(last))
    if context.calendar is not None:
        rows = restricted(rows, star.calendar.filter(context.calendar), "data_sk")
    if context.indicator is not None and "indicador" in fact.columns:
        rows = restricted(rows, star.indicators.filter(context.indicator), "indicador")
    return rows


def inside(star: Star, name: str, context: Context) -> tuple[DataFrame, Column]:
    """The rows that the context leaves without its calendar filters, and a column that tells
    which of them those filters leave too."""
    rows, within = rows_in(star, name, context.without_calendar()), F.lit(True)
    for day, compare in zip(context.days or (None, None), (F.col("data").__ge__, F.col("data").__le__)):
        if day is not None:
            within = within & compare(F.lit(day))
    if context.calendar is not None:
        marked = star.calendar.filter(context.calendar).select("data_sk", F.lit(True).alias("_marked"))
        rows = rows.join(marked, "data_sk", "left")
        within = within & F.coalesce("_marked", F.lit(False))
    return rows, within


def dimension_columns(star: Star, rows: DataFrame, by: list[str]) -> DataFrame:
    """Bring in the attributes of the calendar and of the indicators that a grouping names and
    the fact does not have."""
    wanted = [c for c in by if c not in rows.columns]
    of_day = [c for c in wanted if c in star.calendar.columns]
    of_indicator = [c for c in wanted if c not in of_day and c in star.indicators.columns]
    unknown = [c for c in wanted if c not in of_day and c not in of_indicator]
    if unknown or of_indicator and "indicador" not in rows.columns:
        raise ValueError(f"the fact cannot be grouped by {unknown or of_indicator}")
    if of_day:
        rows = rows.join(star.calendar.select("data_sk", *of_day), "data_sk", "left")
    if of_indicator:
        rows = rows.join(star.indicators.select("indicador", *of_indicator), "indicador", "left")
    return rows
