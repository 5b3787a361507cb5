"""Cleaning steps, each DataFrame to DataFrame and free of shuffles.

A step works on the columns that exist, so relations with fewer columns pass
through; only the columns the score needs are mandatory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill import schemas as S
from requestmill.functions import numeric, temporal, text


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [name for name in columns if name in df.columns]


def _type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def select_available(
    df: DataFrame, columns: Sequence[str] = S.RAW_COLUMNS, carry: Sequence[str] = ()
) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*_present(df, columns), *carry)


def add_absent(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Typed NULL columns for the names that are missing."""
    absent = {n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def null_na_tokens(
    df: DataFrame, tokens: Sequence[str] = S.NA_TOKENS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Texts that mean "missing" become NULL in the named text columns; all unless named."""
    names = [
        n for n in _present(df, columns or df.columns) if isinstance(_type(df, n), T.StringType)
    ]
    if not tokens or not names:
        return df
    return df.withColumns({n: text.null_if_token(n, tokens) for n in names})


def parse_timestamps(
    df: DataFrame,
    columns: Sequence[str] = S.TIMESTAMP_COLUMNS,
    formats: Sequence[str] = temporal.TIMESTAMP_FORMATS,
) -> DataFrame:
    """Make the named columns TIMESTAMP; unreadable text becomes NULL."""
    parsed = {}
    for name in _present(df, columns):
        kind = _type(df, name)
        if isinstance(kind, T.TimestampType):
            continue
        if isinstance(kind, (T.TimestampNTZType, T.DateType)):
            parsed[name] = F.col(name).cast("timestamp")
        else:
            parsed[name] = temporal.parse_timestamp(F.col(name).cast("string"), formats)
    return df.withColumns(parsed) if parsed else df


def parse_numbers(
    df: DataFrame, columns: Sequence[str] = ("latitude", "longitude")
) -> DataFrame:
    """Make the named columns DOUBLE; unreadable text and NaN become NULL."""
    parsed = {}
    for name in _present(df, columns):
        column = F.col(name)
        if isinstance(_type(df, name), T.NumericType):
            parsed[name] = F.nanvl(column.cast("double"), F.lit(None).cast("double"))
        else:
            parsed[name] = numeric.parse_number(column.cast("string"))
    return df.withColumns(parsed) if parsed else df


def outside_box(
    latitude_range: tuple[float, float] = S.LATITUDE_RANGE,
    longitude_range: tuple[float, float] = S.LONGITUDE_RANGE,
) -> Column:
    return numeric.both_outside(
        F.col("latitude"), F.col("longitude"), latitude_range, longitude_range
    )


def bound_coordinates(
    df: DataFrame,
    latitude_range: tuple[float, float] = S.LATITUDE_RANGE,
    longitude_range: tuple[float, float] = S.LONGITUDE_RANGE,
) -> DataFrame:
    """Drop both coordinates of a point outside the box; a lone one is kept."""
    drop = outside_box(latitude_range, longitude_range)
    return df.withColumns(
        {n: F.when(~F.coalesce(drop, F.lit(False)), F.col(n)) for n in ("latitude", "longitude")}
    )


def clean_coordinates(
    df: DataFrame,
    latitude_range: tuple[float, float] = S.LATITUDE_RANGE,
    longitude_range: tuple[float, float] = S.LONGITUDE_RANGE,
) -> DataFrame:
    """Create missing coordinate columns, parse them and apply the box."""
    with_columns = add_absent(df, {"latitude": "double", "longitude": "double"})
    return bound_coordinates(parse_numbers(with_columns), latitude_range, longitude_range)


def normalise_text(df: DataFrame, columns: Sequence[str] = S.TEXT_COLUMNS) -> DataFrame:
    """Strip and upper-case; the text ``NAN`` becomes NULL, blank text stays ``''``."""
    names = _present(df, columns)
    cleaned = {n: text.clean_text(F.col(n).cast("string")) for n in names}
    return df.withColumns(cleaned) if cleaned else df


def category_lookup(
    df: DataFrame, column: str = "borough", mapping: Mapping[str, str] = S.BOROUGH_NAMES
) -> DataFrame:
    """Replace the values found in ``mapping``; the others pass through."""
    if column not in df.columns:
        return df
    return df.withColumn(column, text.look_up(F.col(column), mapping))


def add_date_parts(df: DataFrame, column: str = "created_date") -> DataFrame:
    """Year, month, day, hour and weekday name of the creation time."""
    moment = F.col(column)
    return df.withColumns(
        {
            "created_year": F.year(moment),
            "created_month": F.month(moment),
            "created_day": F.dayofmonth(moment),
            "created_hour": F.hour(moment),
            "created_weekday": temporal.weekday_name(moment),
        }
    )


def add_resolution_hours(df: DataFrame) -> DataFrame:
    """Hours from creation to closing; NULL while open or when negative."""
    with_closed = add_absent(df, {"closed_date": "timestamp"})
    return with_closed.withColumn(
        "resolution_hours", temporal.hours_between(F.col("created_date"), F.col("closed_date"))
    )


def add_status_flags(df: DataFrame) -> DataFrame:
    """Closed means a closing time is present; located means both coordinates are."""
    return df.withColumns(
        {
            "is_closed": F.col("closed_date").isNotNull(),
            "has_location": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
        }
    )


def stamp(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """One processing time for the whole batch."""
    return df.withColumn("processed_at", F.lit(str(run_ts)).cast("timestamp"))


def fill_missing(
    df: DataFrame,
    categorical: Sequence[str] = S.CATEGORICAL_COLUMNS,
    numbers: Sequence[str] = S.NUMERIC_COLUMNS,
    flags: Sequence[str] = S.FLAG_COLUMNS,
) -> DataFrame:
    """UNKNOWN, 0 and false for the listed columns that exist."""
    filled = {}
    for names, value in ((categorical, S.UNKNOWN), (numbers, 0), (flags, False)):
        for name in _present(df, names):
            filled[name] = F.coalesce(F.col(name), F.lit(value).cast(_type(df, name)))
    return df.withColumns(filled) if filled else df


def add_quality_score(
    df: DataFrame, weights: Mapping[str, int] = S.SCORE_WEIGHTS, unknown: str = S.UNKNOWN
) -> DataFrame:
    """Completeness score, 0 to 100, of a filled row.

    A flag counts when true, a text of the fill list when it is not the fill
    value, any other column when it is not NULL.
    """
    total = F.lit(0)
    for name, points in weights.items():
        if isinstance(_type(df, name), T.BooleanType):
            earned = F.col(name)
        elif name in S.CATEGORICAL_COLUMNS:
            earned = F.col(name) != unknown
        else:
            earned = F.col(name).isNotNull()
        total = total + F.when(earned, points).otherwise(0)
    return df.withColumn("data_quality_score", total)


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove the rows in which every named column is NULL; all unless named."""
    return df.dropna(how="all", subset=list(columns) if columns else None)


def format_timestamps(
    df: DataFrame,
    columns: Sequence[str] = ("created_date", "closed_date", "processed_at"),
    blank: Sequence[str] = ("closed_date", "processed_at"),
) -> DataFrame:
    """Timestamps as text, whole seconds; NULL becomes ``''`` in the ``blank`` columns."""
    formatted = {}
    for name in _present(df, columns):
        value = temporal.to_sql_seconds(F.col(name))
        formatted[name] = F.coalesce(value, F.lit("")) if name in blank else value
    return df.withColumns(formatted) if formatted else df


def restore_timestamps(
    df: DataFrame,
    columns: Sequence[str] = ("created_date", "closed_date", "processed_at"),
    tokens: Sequence[str] = S.NULL_TIMESTAMP_TOKENS,
) -> DataFrame:
    """The way back from text: null tokens to NULL, then parse."""
    return parse_timestamps(null_na_tokens(df, tokens, columns), columns)


def convert_epoch_timestamps(
    df: DataFrame, columns: Sequence[str] = ("created_date", "closed_date", "processed_at")
) -> DataFrame:
    """Nanosecond numbers or text to TIMESTAMP, for the alternative load."""
    names = _present(df, columns)
    return df.withColumns(
        {n: temporal.epoch_ns_to_timestamp(F.col(n).cast("string")) for n in names}
    )


def canonical_columns(
    df: DataFrame, order: Sequence[str] = S.PROCESSED_COLUMNS, carry: Sequence[str] = ()
) -> DataFrame:
    """The processed columns that exist, in their fixed order."""
    return select_available(df, order, carry)
