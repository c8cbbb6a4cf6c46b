"""Text of labels and cards."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The mathematical bold digits.
BOLD_DIGITS = "𝟬𝟭𝟮𝟯𝟰𝟱𝟲𝟳𝟴𝟵"


def two_digits(value: Column) -> Column:
    """Two digits, half away from zero, of the number as its first fifteen significant digits give it:
    all that a double surely holds, so that 8.694999999999999 is 8.695. From 1e15 on there are no
    digits after the point to round."""
    digits = F.format_string("%.14e", value).cast("decimal(38,18)").cast("decimal(22,2)").cast("string")
    large = F.translate(F.format_number(value, 2), ",", "")
    return F.when(F.abs(value) < 1e15, digits).when(value.isNotNull(), large)


def _commas(number: Column) -> Column:
    return F.translate(number, ".", ",")


def number_label(value: Column, prefix: str = "", suffix: str = "") -> Column:
    """8.695 -> 8,70 with the given text around it; null stays null."""
    return F.concat(F.lit(prefix), _commas(two_digits(value)), F.lit(suffix))


def percent_label(value: Column) -> Column:
    return number_label(value, suffix="%")


def currency_label(value: Column) -> Column:
    return number_label(value, prefix="R$ ")


def _unsigned(number: Column) -> Column:
    return F.ltrim(number, F.lit("-"))


def _sign(number: Column, positive: str) -> Column:
    """The sign of the rounded number: what rounds to zero is shown as a plain zero."""
    zero = _unsigned(number) == "0.00"
    return F.when(zero, "").when(F.startswith(number, F.lit("-")), "-").otherwise(positive)


def signed_points(value: Column) -> Column:
    """+0,41 p.p. / -0,41 p.p. / 0,00 p.p."""
    rounded = two_digits(value)
    return F.concat(_sign(rounded, "+"), _commas(_unsigned(rounded)), F.lit(" p.p."))


def currency_thousands(value: Column) -> Column:
    """R$ 1.234,50 with grouped thousands."""
    rounded = two_digits(value)
    grouped = F.regexp_replace(_commas(_unsigned(rounded)), r"\B(?=(\d{3})+,)", ".")
    return F.concat(_sign(rounded, ""), F.lit("R$ "), grouped)


def bold_digits(text: Column) -> Column:
    return F.translate(text, "0123456789", BOLD_DIGITS)
