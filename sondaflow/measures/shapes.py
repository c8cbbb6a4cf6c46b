"""The five shapes all measures reduce to: averages, single values, series by date,
values as of a last date, and differences across facts.

Every shape aggregates before it shuffles; windows run only over series that
are already reduced to one row per date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sondaflow.functions.numbers import blank_minus, is_filled, mean_of, single_value


# ---------------------------------------------------------------- groups

def averages(rows: DataFrame, by: list[str], values: dict[str, str]) -> DataFrame:
    """AVERAGE of each column in one aggregate: ``values`` maps measure name to column."""
    return rows.groupBy(*by).agg(*[F.avg(c).alias(name) for name, c in values.items()])


def single_values(rows: DataFrame, by: list[str], values: dict[str, str]) -> DataFrame:
    return rows.groupBy(*by).agg(
        *[single_value(F.col(c)).alias(name) for name, c in values.items()])


def mean_difference(left: DataFrame, minuend: str, right: DataFrame, subtrahend: str,
                    by: list[str], name: str) -> DataFrame:
    """Difference of two averages, each over its own fact.

    The facts are stacked and averaged in one aggregate: a single shuffle, no
    join that could multiply rows, and null group keys match by themselves.
    """
    nothing = F.lit(None).cast("double")
    stacked = left.select(*by, F.col(minuend).alias("_left"), nothing.alias("_right")).unionByName(
        right.select(*by, nothing.alias("_left"), F.col(subtrahend).alias("_right")))
    means = averages(stacked, by, {"_left": "_left", "_right": "_right"})
    return means.select(*by, blank_minus(F.col("_left"), F.col("_right")).alias(name))


# ---------------------------------------------------------------- series

def by_date(rows: DataFrame, series: list[str], values: dict[str, str]) -> DataFrame:
    """One row per series and date: at most as many rows per series as the calendar has days."""
    return averages(rows, [*series, "data"], values)


def _series(series: list[str]) -> Window:
    """Rows of one series. A chart without a series column is one series; after ``by_date``
    that is one row per calendar day, so a single partition stays small."""
    return Window.partitionBy(*[F.col(c) for c in series] or [F.lit(0)])


def last_date(series: list[str], value: str) -> Column:
    """The last date of the series that has a value, on each of its rows."""
    return F.max(F.when(F.col(value).isNotNull(), F.col("data"))).over(_series(series))


def last_point(series: list[str], value: str) -> Column:
    """The value on the last date that has one, else null."""
    return F.when(F.col("data") == last_date(series, value), F.col(value))


def with_last_points(daily: DataFrame, series: list[str], points: dict[str, str]) -> DataFrame:
    return daily.withColumns({name: last_point(series, v) for name, v in points.items()})


def with_highlight(daily: DataFrame, series: list[str], value: str, start: str, history: str,
                   recent: str, point: str | None = None, days: int = 30) -> DataFrame:
    """Split a series for its chart. The recent part starts at the latest date with a value
    at least ``days`` before the last one, else at the first; that date is in both parts.
    ``point`` adds the value on the last date, from the window that is there anyway."""
    window = _series(series)
    filled = F.when(F.col(value).isNotNull(), F.col("data"))
    cut = daily.withColumn("_last", F.max(filled).over(window))
    before = F.when(filled <= F.date_sub("_last", days), filled)
    begun = cut.withColumn(start, F.coalesce(F.max(before).over(window), F.min(filled).over(window)))
    parts = {
        history: F.when(F.col("data") <= F.col(start), F.col(value)),
        recent: F.when(F.col("data") >= F.col(start), F.col(value)),
    }
    if point:
        parts[point] = F.when(F.col("data") == F.col("_last"), F.col(value))
    return begun.withColumns(parts).drop("_last")


def shown(daily: DataFrame, measures: list[str]) -> DataFrame:
    """A visual drops the rows in which all its measures are blank."""
    return daily.filter(reduce(Column.__or__, [F.col(m).isNotNull() for m in measures]))


# ----------------------------------------------------------------- as of

def as_of_own_last_date(rows: DataFrame, by: list[str], values: dict[str, str],
                        counts: Column | None = None) -> DataFrame:
    """Averages on each group's own last date.

    ``counts`` says which rows may set the last date; the average on that date
    is over all its rows. Rows are first reduced to one per group and date, then
    to one per group, without sorting or joining back.
    """
    eligible = F.lit(True) if counts is None else counts
    columns = list(dict.fromkeys(values.values()))
    reduced = rows.groupBy(*by, "data").agg(
        F.max(F.when(eligible, 1)).alias("_eligible"),
        *[F.sum(c).alias(f"_sum_{c}") for c in columns],
        *[F.count(c).alias(f"_count_{c}") for c in columns])
    # Dates are unique within a group here, and each part alone fits a hash aggregate.
    parts = [f"_{part}_{c}" for part in ("sum", "count") for c in columns]
    latest = reduced.filter("_eligible = 1").groupBy(*by).agg(
        F.max("data").alias("data"), *[F.max_by(p, "data").alias(p) for p in parts])
    return latest.select(
        *by, "data",
        *[mean_of(F.col(f"_sum_{c}"), F.col(f"_count_{c}")).alias(name)
          for name, c in values.items()])


def filled_last_date(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """As above, where only a non-blank, non-zero value may set the last date."""
    return as_of_own_last_date(rows, by, {name: value}, is_filled(F.col(value)))


def on_last_date_of(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows on the last date of ``whole`` (a wider selection of the same fact).

    The date is a scalar subquery: one maximum over one column, whose value the
    scan of the rows then uses to skip row groups of other days.
    """
    return rows.filter(F.col("data") == whole.agg(F.max("data")).scalar())


def as_of_last_date_of(rows: DataFrame, by: list[str], within: list[str], values: dict[str, str],
                       inside: Column) -> DataFrame:
    """Averages of the rows that are ``inside``, on the last date that all rows of the same
    ``within`` columns have. One scan: inner and outer rows are told apart in the aggregate."""
    columns = list(dict.fromkeys(values.values()))
    reduced = rows.groupBy(*dict.fromkeys([*within, *by]), "data").agg(
        F.max(F.when(inside, 1)).alias("_inside"),
        *[F.sum(F.when(inside, F.col(c))).alias(f"_sum_{c}") for c in columns],
        *[F.count(F.when(inside, F.col(c))).alias(f"_count_{c}") for c in columns])
    parts = [f"_{part}_{c}" for part in ("sum", "count") for c in columns]
    if not by:
        # One group, in which dates are unique after the first aggregate.
        last = reduced.groupBy().agg(*[F.max_by(p, "data").alias(p) for p in parts])
        return last.select(*[mean_of(F.col(f"_sum_{c}"), F.col(f"_count_{c}")).alias(n) for n, c in values.items()])
    if not within:
        last = reduced.filter(F.col("data") == rows.agg(F.max("data")).scalar())
    else:
        ends = reduced.groupBy(*within).agg(F.max("data").alias("_end"))
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in within]
        last = reduced.alias("r").join(ends.alias("e"), [*same, F.col("r.data") == F.col("e._end")]).select("r.*")
    last = last.filter("_inside = 1").groupBy(*by).agg(*[F.sum(p).alias(p) for p in parts])
    return last.select(*by, *[mean_of(F.col(f"_sum_{c}"), F.col(f"_count_{c}")).alias(name) for name, c in values.items()])
