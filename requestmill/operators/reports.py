"""Reports over the processed relation. Each is one aggregate or one top-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill.functions import numeric, temporal, text
from requestmill.operators import clean
from requestmill.schemas import KEY, PROCESSED_COLUMNS

# Averages are rounded, as their last digits depend on the order of the sum.
DIGITS = 6


def _positive_hours() -> Column:
    """0 stands for "unknown" after the fill, so only positive hours count."""
    return F.when(F.col("resolution_hours") > 0, F.col("resolution_hours"))


def _average_score() -> Column:
    return F.round(F.avg("data_quality_score"), DIGITS)


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def overall_stats(df: DataFrame, digits: int = 2) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(KEY).alias("unique_records"),
        F.count("closed_date").alias("rows_with_closed_date"),
        F.count(_positive_hours()).alias("rows_with_resolution_hours"),
        F.round(F.avg(_positive_hours()), digits).alias("avg_resolution_hours"),
        F.max("created_date").alias("latest_record"),
        F.max("processed_at").alias("last_processed"),
    )


# Columns of the completeness report; for text, blank means not filled.
COMPLETENESS = (
    "unique_key",
    "created_date",
    "closed_date",
    "agency",
    "complaint_type",
    "resolution_hours",
    "is_closed",
    "data_quality_score",
)


def completeness(
    df: DataFrame,
    columns: Sequence[str] = COMPLETENESS,
    nonblank: Sequence[str] = ("agency", "complaint_type"),
) -> DataFrame:
    """Filled count and percent of each column."""
    counts = df.agg(
        F.count("*").alias("total"),
        *[
            F.count_if(
                text.is_filled(F.col(c)) if c in nonblank else F.col(c).isNotNull()
            ).alias(f"{c}_filled")
            for c in columns
        ],
    )
    return counts.withColumns(
        {f"{c}_pct": numeric.percent_of(F.col(f"{c}_filled"), F.col("total")) for c in columns}
    )


def quality_bands(df: DataFrame, high: int = 80, medium: int = 50) -> DataFrame:
    """Score range, and how many rows are high, medium and low."""
    score = F.col("data_quality_score")
    return df.agg(
        _average_score().alias("avg_quality"),
        F.min(score).alias("min_quality"),
        F.max(score).alias("max_quality"),
        F.count_if(score >= high).alias("high_quality_count"),
        F.count_if(score.between(medium, high - 1)).alias("medium_quality_count"),
        F.count_if(score < medium).alias("low_quality_count"),
    )


def top_agencies(df: DataFrame, n: int = 5, column: str = "agency") -> DataFrame:
    """The most frequent values; ties go by name."""
    counts = df.groupBy(column).agg(F.count("*").alias("request_count"))
    return counts.orderBy(F.desc("request_count"), F.asc(column)).limit(n)


def date_range(df: DataFrame, column: str = "created_date") -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def data_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("agency").alias("agencies"),
        F.count_distinct("complaint_type").alias("complaint_types"),
        F.min("created_date").alias("earliest_date"),
        F.max("created_date").alias("latest_date"),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"),
        _average_score().alias("avg_quality"),
        F.min("created_date").alias("earliest_record"),
        F.max("created_date").alias("latest_record"),
    )


def closed_summary(df: DataFrame, status: str = "Closed") -> DataFrame:
    """Rows, average score, and rows in a status whatever its case."""
    return df.agg(
        F.count("*").alias("total_records"),
        _average_score().alias("avg_quality_score"),
        F.count_if(text.equals_ignoring_case(F.col("status"), status)).alias("closed_count"),
    )


def column_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("closed_date").alias("closed_date_count"),
        F.count("resolution_hours").alias("resolution_hours_count"),
        _average_score().alias("avg_quality"),
    )


def run_check(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count("closed_date").alias("rows_with_closed_date"),
        F.count("resolution_hours").alias("rows_with_resolution_hours"),
        F.round(F.avg(_positive_hours()), DIGITS).alias("avg_resolution_hours"),
        F.max("created_date").alias("latest_record"),
        F.max("processed_at").alias("last_processed"),
    )


def average_quality(df: DataFrame) -> DataFrame:
    return df.agg(_average_score().alias("avg_quality"))


def batch_metric_columns() -> list[Column]:
    """Aggregates of a processed batch, for ``agg`` or for ``observe`` during a write."""
    return [
        F.count("*").alias("processed_count"),
        F.coalesce(_average_score(), F.lit(0.0)).alias("avg_quality_score"),
        F.count_if("has_location").alias("records_with_location"),
        F.count_if("is_closed").alias("closed_complaints"),
    ]


def _side_by_side(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw count and batch metrics in one row, without a join."""
    metrics = processed.agg(*batch_metric_columns())
    parts = raw.agg(F.count("*").alias("raw_count")).unionByName(metrics, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def batch_metrics(raw: DataFrame, processed: DataFrame) -> DataFrame:
    return _side_by_side(raw, processed).select(
        "raw_count", "processed_count", "avg_quality_score", "records_with_location"
    )


def transform_summary(
    raw: DataFrame, processed: DataFrame, bookkeeping: Sequence[str] = ("seq", "batch_id")
) -> DataFrame:
    """What the transform did to a batch; ``bookkeeping`` columns are not counted."""
    width = [len([c for c in side.columns if c not in bookkeeping]) for side in (raw, processed)]
    return _side_by_side(raw, processed).select(
        F.col("raw_count").alias("original_records"),
        F.col("processed_count").alias("transformed_records"),
        (F.col("raw_count") - F.col("processed_count")).alias("records_removed"),
        F.lit(width[1] - width[0]).alias("columns_added"),
        F.col("avg_quality_score"),
        F.col("records_with_location"),
        F.col("closed_complaints"),
    )


def cleaning_counts(deduplicated: DataFrame) -> DataFrame:
    """Rows the cleaning steps would change: bad points and negative durations.

    Takes the relation after parsing and deduplication, before cleaning.
    """
    parsed = clean.parse_numbers(deduplicated)
    return parsed.agg(
        F.count_if(clean.outside_box()).alias("invalid_coordinates"),
        F.count_if(F.col("closed_date") < F.col("created_date")).alias("negative_durations"),
    )


def _display(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return temporal.to_sql_seconds(F.col(name))
    return F.col(name).cast("string")


def _unpivot(row: DataFrame, entries: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One output row per entry out of a one-row relation."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(entry, names)]) for entry in entries]
    return row.select(F.inline(F.array(*structs)))


def column_profile(
    df: DataFrame,
    order: Sequence[str] = ("seq",),
    columns: Sequence[str] = PROCESSED_COLUMNS,
) -> DataFrame:
    """Position, name, type, non-null count, row count and first value of each column.

    One pass: the first row is the one lowest in ``order``.
    """
    names = [c for c in columns if c in df.columns]
    first = F.struct(*[_display(df, c).alias(c) for c in names])
    measured = df.agg(
        F.count("*").alias("total"),
        F.min_by(first, F.struct(*order)).alias("first"),
        *[F.count(c).alias(f"filled_{c}") for c in names],
    )
    entries = [
        (
            F.lit(i),
            F.lit(c),
            F.lit(df.schema[c].dataType.simpleString()),
            F.col(f"filled_{c}"),
            F.col("total"),
            F.col("first")[c],
        )
        for i, c in enumerate(names, start=1)
    ]
    labels = ("position", "column_name", "data_type", "non_null", "total", "first_value")
    return _unpivot(measured, entries, labels)


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of each column that has any."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    entries = [(F.lit(c), F.col(c)) for c in names]
    return _unpivot(counts, entries, ("column_name", "null_count")).where("null_count > 0")


def latest_created(
    df: DataFrame,
    n: int = 10,
    columns: Sequence[str] | None = None,
    column: str = "created_date",
    key: str = KEY,
) -> DataFrame:
    """The newest rows by creation time; ties go by key."""
    newest = df.orderBy(F.desc(column), F.asc(key)).limit(n)
    return newest.select(*columns) if columns else newest


def latest_processed(df: DataFrame, n: int = 5) -> DataFrame:
    """The newest rows by processing time, as the run report shows them.

    A blank closing time, which the reporting database stores as 1900-01-01,
    is no closing time.
    """
    newest = df.orderBy(F.desc("processed_at"), F.asc(KEY)).limit(n)
    closed = F.nullif(F.col("closed_date"), F.lit("1900-01-01 00:00:00").cast("timestamp"))
    return newest.select(
        "unique_key",
        "created_date",
        closed.alias("closed_date"),
        "agency",
        "complaint_type",
        "resolution_hours",
        "is_closed",
        "data_quality_score",
        "processed_at",
        F.coalesce(temporal.to_sql_seconds(closed), F.lit("Still Open")).alias("closed_display"),
        text.preview(F.col("complaint_type")).alias("complaint_preview"),
    )


def high_water_mark(df: DataFrame, column: str = "created_date") -> DataFrame:
    """The newest creation time as ``YYYY-MM-DDTHH:MM:SS``."""
    return df.agg(temporal.to_iso_seconds(F.max(column)).alias("last_processed_time"))


def ledger_report(ledger: DataFrame, order: Sequence[str] = ("committed_at", "run_id")) -> DataFrame:
    """Number of batches, the first and the last."""
    place = F.struct(*order)
    return ledger.agg(
        F.count("*").alias("total_batches"),
        F.min_by("run_id", place).alias("first_batch"),
        F.max_by("run_id", place).alias("last_batch"),
        F.coalesce(F.sum("raw_count"), F.lit(0)).alias("raw_records"),
    )


def recent_batches(
    ledger: DataFrame, n: int = 5, order: Sequence[str] = ("committed_at", "run_id")
) -> DataFrame:
    """The last ``n`` batches."""
    return ledger.orderBy(*[F.desc(c) for c in order]).limit(n)


def state_report(state: DataFrame, ledger: DataFrame) -> DataFrame:
    """Last run, last processed time and all records so far; N/A and 0 when unknown.

    Both inputs may be empty. Each is reduced to one row, the rows are united and
    folded, so nothing is joined.
    """
    runs = ledger.agg(
        temporal.to_iso_seconds(F.max("committed_at")).alias("last_successful_run"),
        F.sum("processed_count").alias("total_records_processed"),
    )
    marks = state.agg(F.max("last_processed_time").alias("last_processed_date"))
    both = runs.unionByName(marks, allowMissingColumns=True)
    defaults = {
        "last_successful_run": "N/A",
        "last_processed_date": "N/A",
        "total_records_processed": 0,
    }
    return both.agg(
        *[F.coalesce(F.max(c), F.lit(default)).alias(c) for c, default in defaults.items()]
    )


def load_status(raw_ok: bool, processed_ok: bool, publish_ok: bool | None) -> str:
    """Overall status of a load; ``publish_ok`` is None when nothing was published."""
    if not (raw_ok and processed_ok):
        return "failed"
    return "partial" if publish_ok is False else "success"


def processed_files_report(processed: DataFrame, last: int = 5) -> DataFrame:
    """How many files were read, the first and the last one, and the last few, newest first.

    Files are ordered by their time, then by name.
    """
    place = F.struct("file_time", "file_path")
    totals = processed.agg(
        F.count("*").alias("n_files"),
        F.min_by("file_path", place).alias("first_file"),
        F.max_by("file_path", place).alias("last_file"),
    )
    newest = processed.orderBy(F.desc("file_time"), F.desc("file_path")).limit(last)
    names = newest.agg(
        F.transform(
            F.reverse(F.array_sort(F.collect_list(place))), lambda x: x["file_path"]
        ).alias("last_files")
    )
    return totals.join(names)  # one row each
