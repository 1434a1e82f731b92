"""Numbers out of text, and ratios. Nothing here raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.names import quoted


def parse_number(
    text: Column,
    thousands: str | None = None,
    decimal: str = ".",
    nulls: Sequence[str] = ("", "-"),
) -> Column:
    """Text to double. Quotes are dropped; NULL for ``nulls`` and unreadable text.

    A ``decimal`` other than the point is replaced everywhere, so "1.234,5"
    with a decimal comma becomes two points and hence NULL.
    """
    drop = '"' + (thousands or "")
    plain = F.trim(F.translate(text, drop, ""))
    if decimal != ".":
        plain = F.translate(plain, decimal, ".")
    if nulls:
        plain = F.when(~plain.isin(list(nulls)), plain)
    return plain.try_cast("double")


def parse_integer(text: Column, target: str = "int") -> Column:
    """Text to an integer type; a decimal fraction is cut off, as in "2018.0".

    One attempt serves both forms: what reads as a decimal is cut off at the point. Text
    with an exponent, a type suffix, "NaN" or "Infinity" is no integer.
    """
    plain = F.trim(text)
    whole = F.substring_index(plain, ".", 1)
    fraction = F.substring(plain, F.length(whole) + 2, F.length(plain))
    return F.when(F.translate(fraction, "0123456789", "") == "", whole.try_cast(target))


def integer_sql(name: str, target: str = "int") -> str:
    """:func:`parse_integer` of a column, as SQL text."""
    plain = f"trim({quoted(name)})"
    whole = f"substring_index({plain}, '.', 1)"
    fraction = f"substring({plain}, length({whole}) + 2, length({plain}))"
    return f"CASE WHEN translate({fraction}, '0123456789', '') = '' THEN try_cast({whole} AS {target}) END"


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """Quotient as double; NULL for a zero denominator."""
    value = F.try_divide(numerator, denominator)
    return value if digits is None else F.round(value, digits)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is positive, else NULL."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator))
