"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from requestmill.functions.text import strip_blanks

def parse_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number gives NULL.

    Spark's own cast also takes suffixes such as ``1.0d``, hexadecimal numbers and
    ``nan``. Those are told apart by their characters, which costs less than a
    regular expression.
    """
    stripped = strip_blanks(text)
    lower = F.lower(stripped)
    digits = F.contains(F.lit("0123456789."), F.right(stripped, F.lit(1)))
    infinite = lower.endswith("inf") | lower.endswith("infinity")
    plain = (digits & ~lower.contains("x")) | infinite
    return F.when(plain, stripped.try_cast("double"))


def both_outside(
    latitude: Column,
    longitude: Column,
    latitude_range: tuple[float, float],
    longitude_range: tuple[float, float],
) -> Column:
    """True when both coordinates are present and the point is not in the box."""
    inside = latitude.between(*latitude_range) & longitude.between(*longitude_range)
    return latitude.isNotNull() & longitude.isNotNull() & ~inside


def percent_of(part: Column, total: Column, digits: int = 1) -> Column:
    """Share in percent; NULL for an empty table."""
    return F.round(F.try_divide(part.cast("double"), total.cast("double")) * 100, digits)
