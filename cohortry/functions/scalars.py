"""Small scalar helpers whose exact result other engines can repeat."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_round(value: Column, digits: int) -> Column:
    """Half-up rounding on a decimal with ten places, given back as double.

    Rounding a bare double differs between engines where its decimal
    expansion lies next to a tie. What lies beyond ten places counts as
    noise of the arithmetic, and engines convert doubles alike only up to about
    there; 28 digits are left before the point.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_share(part: Column, whole: Column, digits: int = 2) -> Column:
    return exact_round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number filled with zeros; longer numbers stay whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def days_between(earlier: Column, later: Column) -> Column:
    """Calendar days from ``earlier`` to ``later``; the time of day is ignored."""
    return F.datediff(later.cast("date"), earlier.cast("date")).cast("bigint")


def plain_number(value: Column, digits: int = 2) -> Column:
    """A number as text with a fixed count of decimals."""
    return value.cast(f"decimal(20,{digits})").cast("string")


def long_date(day: Column) -> Column:
    return F.date_format(day, "dd MMM yyyy")


def today(as_of: date | None = None) -> Column:
    """The given day, or the session's current date."""
    return F.current_date() if as_of is None else F.lit(as_of)
