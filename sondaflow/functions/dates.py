"""Date expressions. All built-in, so they stay inside generated code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def parse_date(column: Column, date_format: str) -> Column:
    """Text to date; text that does not fit the format becomes null instead of an error."""
    return F.try_to_date(column.cast("string"), date_format)


def date_key(day: Column) -> Column:
    """2024-01-31 -> 20240131. Arithmetic is cheaper than formatting and parsing text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def half_year(day: Column) -> Column:
    return F.when(F.month(day) <= 6, 1).otherwise(2)


def workday_flag(day: Column) -> Column:
    """0 on Saturdays and Sundays, else 1; public holidays are not known here."""
    return F.when(F.dayofweek(day).isin(1, 7), 0).otherwise(1)


def day_month_year(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def trailing_months(day: Column, as_of: date, months: int) -> Column:
    """The report filter "last n months": both ends belong to the range."""
    end = F.lit(as_of)
    return day.between(F.add_months(F.date_add(end, 1), -months), end)
