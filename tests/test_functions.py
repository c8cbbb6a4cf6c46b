from datetime import date

import pytest
from pyspark.sql import functions as F

from sondaflow.functions import dates, numbers, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    frame = spark.createDataFrame([tuple(v[1] for v in values.values())], schema or "x int")
    return frame.select(column.alias("r")).first().r


@pytest.mark.parametrize("raw, fmt, expected", [
    ("2024-02-29", "yyyy-MM-dd", date(2024, 2, 29)),
    ("2024-02-30", "yyyy-MM-dd", None),
    ("31/12/1999", "dd/MM/yyyy", date(1999, 12, 31)),
    ("1999-12-31", "dd/MM/yyyy", None),
    ("", "yyyy-MM-dd", None),
    (None, "yyyy-MM-dd", None),
])
def test_parse_date(spark, raw, fmt, expected):
    assert one(spark, dates.parse_date(F.col("v"), fmt), v=("string", raw)) == expected


def test_date_parts(spark):
    sunday = {"d": ("date", date(1995, 1, 1))}
    assert one(spark, dates.date_key(F.col("d")), **sunday) == 19950101
    assert one(spark, dates.half_year(F.col("d")), **sunday) == 1
    assert one(spark, dates.workday_flag(F.col("d")), **sunday) == 0
    assert one(spark, dates.workday_flag(F.col("d")), d=("date", date(1995, 1, 2))) == 1
    assert one(spark, dates.half_year(F.col("d")), d=("date", date(1995, 7, 1))) == 2
    assert one(spark, dates.day_month_year(F.col("d")), **sunday) == "01/01/1995"


@pytest.mark.parametrize("day, inside", [
    (date(2023, 7, 31), False), (date(2023, 8, 1), True), (date(2024, 1, 31), True),
    (date(2024, 2, 1), False)])
def test_trailing_months_holds_both_ends(spark, day, inside):
    column = dates.trailing_months(F.col("d"), date(2024, 1, 31), 6)
    assert one(spark, column, d=("date", day)) is inside


@pytest.mark.parametrize("rate, inflation, expected", [
    (13.75, 4.65, 8.6957), (10.0, 0.0, 10.0), (5.0, -100.0, None), (None, 4.0, None), (3.0, None, None)])
def test_real_rate(spark, rate, inflation, expected):
    column = numbers.real_rate(F.col("r"), F.col("i"))
    assert one(spark, column, r=("double", rate), i=("double", inflation)) == expected


@pytest.mark.parametrize("left, right, expected", [
    (5.0, 2.0, 3.0), (None, 2.0, -2.0), (5.0, None, 5.0), (None, None, None)])
def test_blank_minus(spark, left, right, expected):
    column = numbers.blank_minus(F.col("a"), F.col("b"))
    assert one(spark, column, a=("double", left), b=("double", right)) == expected


@pytest.mark.parametrize("value, divergence, table", [
    (0.5, numbers.TOP5_HIGHER, numbers.TOP5_HIGHER),
    (-0.5, numbers.TOP5_LOWER, numbers.TABLE_LOWER),
    (0.0, numbers.TOP5_HIGHER, numbers.TABLE_EQUAL),
    (None, numbers.TOP5_HIGHER, numbers.TABLE_EQUAL)])
def test_colours(spark, value, divergence, table):
    assert one(spark, numbers.divergence_colour(F.col("v")), v=("double", value)) == divergence
    assert one(spark, numbers.table_colour(F.col("v")), v=("double", value)) == table


@pytest.mark.parametrize("value, percent, currency", [
    (8.695, "8,70%", "R$ 8,70"), (5.1234, "5,12%", "R$ 5,12"), (0.0, "0,00%", "R$ 0,00"),
    (8.694999999999999, "8,70%", "R$ 8,70"), (0.00499999996, "0,00%", "R$ 0,00"),
    (1e31, "10000000000000000000000000000000,00%", "R$ 10000000000000000000000000000000,00"),
    (2e14, "200000000000000,00%", "R$ 200000000000000,00"), (-0.001, "0,00%", "R$ 0,00"), (-1.005, "-1,01%", "R$ -1,01"), (None, None, None)])
def test_labels(spark, value, percent, currency):
    assert one(spark, text.percent_label(F.col("v")), v=("double", value)) == percent
    assert one(spark, text.currency_label(F.col("v")), v=("double", value)) == currency


@pytest.mark.parametrize("value, expected", [
    (0.41, "+0,41 p.p."), (-0.41, "-0,41 p.p."), (0.0, "0,00 p.p."), (0.004, "0,00 p.p."),
    (-0.004, "0,00 p.p."), (None, None)])
def test_signed_points(spark, value, expected):
    assert one(spark, text.signed_points(F.col("v")), v=("double", value)) == expected


@pytest.mark.parametrize("value, expected", [
    (1234567.5, "R$ 1.234.567,50"), (5.4, "R$ 5,40"), (-1234.5, "-R$ 1.234,50")])
def test_currency_thousands(spark, value, expected):
    assert one(spark, text.currency_thousands(F.col("v")), v=("double", value)) == expected


def test_bold_digits(spark):
    assert one(spark, text.bold_digits(F.col("v")), v=("string", "31/01/2024")) == "𝟯𝟭/𝟬𝟭/𝟮𝟬𝟮𝟰"


@pytest.mark.parametrize("values, expected", [
    ([3.0, 3.0], 3.0), ([3.0, 4.0], None), ([3.0, None], None), ([None], None)])
def test_single_value(spark, values, expected):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert frame.agg(numbers.single_value(F.col("v")).alias("s")).first().s == expected
