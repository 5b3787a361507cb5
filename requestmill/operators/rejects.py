"""Landed rows that cannot be taken: why, what they were and where they lie.

A reject is one record of one file. Where files are read again, so are their rejects; ``unseen`` tells
which of them are new.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON, RECORD, SOURCE = "_reason", "_record", "_source_file"
CORRUPT = "_corrupt_record"
MALFORMED, UNDATED, FUTURE = "malformed", "no creation time", "created in the future"
EARLY = "before the increment"  # counted, not kept: the file still has the row
SCHEMA = "reason string, record string, file string, reject_id string, run string"


def with_reason(
    rows: DataFrame,
    raw_columns: Sequence[str],
    latest: datetime | None = None,
    undated: bool = True,
    column: str = "created_date",
) -> DataFrame:
    """Rows with parsed times, and why each is rejected; NULL for those that are taken.

    ``latest``: rows created after it are rejected. ``undated``: so are rows without a
    creation time. Rows the reader could not read are rejected in any case.
    """
    moment = F.col(column)
    reason: Column = F.lit(None).cast("string")
    if latest is not None:
        bound = F.lit(latest.isoformat(sep=" ")).cast("timestamp")
        reason = F.when(moment > bound, FUTURE)
    if undated:
        reason = F.coalesce(reason, F.when(moment.isNull(), UNDATED))
    record: Column = F.to_json(F.struct(*raw_columns))
    if CORRUPT in rows.columns:
        broken = F.col(CORRUPT)
        reason = F.when(broken.isNotNull(), MALFORMED).otherwise(reason)
        record = F.coalesce(broken, record)
    marked = rows.withColumn(REASON, reason)
    marked = marked.withColumn(RECORD, F.when(F.col(REASON).isNotNull(), record))
    return marked.drop(CORRUPT)


def without_reason(rows: DataFrame) -> DataFrame:
    """The same columns for rows that are all taken."""
    nothing = F.lit(None).cast("string")
    return rows.withColumns({REASON: nothing, RECORD: nothing, SOURCE: nothing})


def marked_early(marked: DataFrame, bound: Column, column: str = "created_date") -> DataFrame:
    """Rows created before ``bound`` get a reason, too; they are to be counted and left."""
    early = F.col(REASON).isNull() & (F.col(column) < bound)
    return marked.withColumn(REASON, F.when(early, EARLY).otherwise(F.col(REASON)))


def taken(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REASON).isNull()).drop(REASON, RECORD, SOURCE)


def rejected(marked: DataFrame) -> DataFrame:
    """(reason, record, file, reject_id): the record as it was landed, or as JSON."""
    file = F.col(SOURCE) if SOURCE in marked.columns else F.lit(None).cast("string")
    rows = marked.where(F.col(REASON).isNotNull()).select(
        F.col(REASON).alias("reason"), F.col(RECORD).alias("record"), file.alias("file")
    )
    parts = (F.coalesce(F.col(c), F.lit("")) for c in ("file", "reason", "record"))
    return rows.withColumn("reject_id", F.sha2(F.concat_ws("\0", *parts), 256))


def unseen(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rejects that are not among the known ones. A record that a file holds twice is two rejects."""
    return rows.join(known.select("reject_id").distinct(), "reject_id", "left_anti").select(*rows.columns)


def reject_counts(rejected_rows: DataFrame) -> DataFrame:
    return rejected_rows.groupBy("reason").agg(F.count("*").alias("n_rows"))
