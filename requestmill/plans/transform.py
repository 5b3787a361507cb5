"""The transform of a raw batch, as one lazy chain of DataFrame steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill import schemas as S
from requestmill.functions.temporal import TIMESTAMP_FORMATS
from requestmill.operators import clean, dedup

MANDATORY = ("unique_key", "created_date", "complaint_type", "agency", "borough")


@dataclass(frozen=True)
class TransformOptions:
    """What the transform may vary in; the defaults are the standard rules."""

    order: Sequence[str] = ("seq",)
    carry: Sequence[str] = ()
    na_tokens: Sequence[str] = S.NA_TOKENS
    timestamp_formats: Sequence[str] = TIMESTAMP_FORMATS
    latitude_range: tuple[float, float] = S.LATITUDE_RANGE
    longitude_range: tuple[float, float] = S.LONGITUDE_RANGE
    boroughs: Mapping[str, str] = field(default_factory=lambda: dict(S.BOROUGH_NAMES))
    weights: Mapping[str, int] = field(default_factory=lambda: dict(S.SCORE_WEIGHTS))
    timestamps_as_text: bool = False


def parse_and_dedup(raw: DataFrame, options: TransformOptions = TransformOptions()) -> DataFrame:
    """The part before cleaning: missing-value texts, timestamps, first row per key.

    Timestamps are parsed ahead of the exchange, which then carries 8 bytes for
    each instead of their text.
    """
    missing = [c for c in MANDATORY if c not in raw.columns]
    if missing:
        raise ValueError(f"raw relation lacks {', '.join(missing)}")
    return (
        raw.withColumn(S.KEY, F.col(S.KEY).cast("string"))
        .transform(clean.null_na_tokens, options.na_tokens, S.RAW_COLUMNS)
        .transform(clean.parse_timestamps, formats=options.timestamp_formats)
        .transform(dedup.dedup_first, options.order)
    )


def transform(
    raw: DataFrame,
    run_ts: datetime | str,
    options: TransformOptions = TransformOptions(),
) -> DataFrame:
    """Raw batch to processed relation.

    Deduplication comes before cleaning, the location flag before the fill, and
    the score after it. Columns absent from the batch are created where the
    rules ask for them and stay absent otherwise. Rows with every column NULL
    cannot occur at the end, as the flags never are, so no step looks for them.
    """
    processed = (
        parse_and_dedup(raw, options)
        .transform(clean.clean_coordinates, options.latitude_range, options.longitude_range)
        .transform(clean.normalise_text)
        .transform(clean.category_lookup, "borough", options.boroughs)
        .transform(clean.add_date_parts)
        .transform(clean.add_resolution_hours)
        .transform(clean.add_status_flags)
        .transform(clean.stamp, run_ts)
        .transform(clean.fill_missing)
        .transform(clean.add_quality_score, options.weights)
    )
    if options.timestamps_as_text:
        processed = clean.format_timestamps(processed)
    return clean.canonical_columns(processed, carry=options.carry)
