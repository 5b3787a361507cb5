"""Timestamp expressions. The session zone is UTC, so wall time is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts tried after ISO text, in this order.
TIMESTAMP_FORMATS = (
    "M/d/yyyy h:mm:ss a",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy",
    "yyyyMMdd",
    "yyyy/MM/dd",
)

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
SQL_SECONDS = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Text to timestamp; unreadable text gives NULL.

    An offset in the text is dropped, not applied: the cast goes through a type
    without time zone. Each layout is tried per row.
    """
    iso = text.try_cast("timestamp_ntz").cast("timestamp")
    others = [F.try_to_timestamp(text, F.lit(layout)).cast("timestamp") for layout in formats]
    return F.coalesce(iso, *others)


def normalise_since(text: Column) -> Column:
    """Cut the fraction and put a ``T`` between date and time."""
    return F.translate(F.substring_index(text, ".", 1), " ", "T")


def epoch_ns_to_timestamp(text: Column) -> Column:
    """Whole numbers are nanoseconds since 1970; anything else is parsed as text."""
    nanos = text.try_cast("bigint")
    micros = F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000))
    whole = F.trim(text).rlike(r"^[+-]?\d{1,19}$")
    return F.when(whole, F.timestamp_micros(micros)).otherwise(parse_timestamp(text))


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours with their fraction; NULL when the end precedes the start."""
    hours = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6) / F.lit(3600.0)
    return F.when(hours >= 0, hours)


def weekday_name(moment: Column) -> Column:
    """Full English name, such as ``Friday``."""
    return F.date_format(moment, "EEEE")


def to_iso_seconds(moment: Column) -> Column:
    return F.date_format(moment, ISO_SECONDS)


def to_sql_seconds(moment: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, the fraction cut off."""
    return F.date_format(moment, SQL_SECONDS)


def to_milliseconds(moment: Column) -> Column:
    return F.date_trunc("millisecond", moment)
