"""The high-water mark, the batch ledger, the ledger of processed files, and rows that wait.

Each run adds a folder to a ledger. When there are ``FOLD_AT`` of them they are folded into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from requestmill.schemas import LEDGER_SCHEMA, PROCESSED_FILES_SCHEMA, STATE_SCHEMA
from requestmill.sources import files
from requestmill.sources.landing import normalise_since


FOLD_AT = 100


def save_mark(spark: SparkSession, path: str, mark: str, updated_at: datetime) -> None:
    """Replace the mark. Call it last, when every sink has succeeded."""
    document = {
        "last_processed_time": normalise_since(mark),
        "updated_at": updated_at.isoformat(),
    }
    files.write_document(spark, path, document)


def load_mark(spark: SparkSession, path: str) -> str | None:
    """The last mark, or None before the first run."""
    state = files.read_document(spark, path) or {}
    mark = state.get("last_processed_time")
    return normalise_since(mark) if mark else None


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state as a relation of at most one row."""
    if not files.path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).json(path)


def append_ledger(spark: SparkSession, path: str, entry: dict[str, Any]) -> DataFrame:
    """Write one run's ledger row; writing the same run again replaces it."""
    row = spark.createDataFrame([[entry.get(n) for n in LEDGER_SCHEMA.names]], LEDGER_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={entry['run_id']}")
    fold_ledger(spark, path, FOLD_AT)
    return row


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row for each run, whether its entry stands alone or in a fold or, after a fold that was
    broken off, in both."""
    if not files.path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(path).select(*LEDGER_SCHEMA.names)
    return rows.dropDuplicates(["run_id"])


def _fold(spark: SparkSession, path: str, rows: Callable[[], DataFrame], least: int) -> int:
    """Put the rows of all runs into one folder; returns how many folders went.

    Rows are written before the old folders are deleted, so none is lost.
    """
    old = [n for n in files.child_names(spark, path) if n.startswith("run=")]
    if len(old) < max(2, least):
        return 0
    rows().write.parquet(f"{path}/run=folded-{uuid.uuid4().hex}")
    for name in old:
        files.delete_folder(spark, f"{path}/{name}")
    return len(old)


def fold_ledger(spark: SparkSession, path: str, least: int = 2) -> int:
    """One folder for the entries of all runs, if there are ``least`` folders."""
    return _fold(spark, path, lambda: read_ledger(spark, path), least)


def fold_files(spark: SparkSession, path: str, least: int = 2) -> int:
    """One folder for the files that all runs have read."""
    return _fold(spark, path, lambda: processed_files(spark, path), least)


def record_files(spark: SparkSession, path: str, read: DataFrame, run_id: str) -> None:
    """Note which files a run has read; the same run again replaces its note."""
    read.withColumn("run_id", F.lit(run_id)).select(*PROCESSED_FILES_SCHEMA.names).write.mode(
        "overwrite"
    ).parquet(f"{path}/run={run_id}")
    fold_files(spark, path, FOLD_AT)


def processed_files(spark: SparkSession, path: str) -> DataFrame:
    if not files.path_exists(spark, path):
        return spark.createDataFrame([], PROCESSED_FILES_SCHEMA)
    names = PROCESSED_FILES_SCHEMA.names
    rows = spark.read.schema(PROCESSED_FILES_SCHEMA).parquet(path).select(*names)
    return rows.distinct()  # a fold that was broken off leaves entries twice


def pending_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that wait for their time, as the last run that went well left them."""
    folder = (files.read_document(spark, f"{path}/current.json") or {}).get("folder")
    return spark.read.parquet(f"{path}/{folder}") if folder else None


def write_pending(rows: DataFrame, path: str, run_id: str) -> str:
    """A run's waiting rows; they count once ``keep_pending`` names their folder."""
    folder = f"run={run_id}"
    # rows come twice where a run failed after it had noted them
    rows.dropDuplicates().write.mode("overwrite").parquet(f"{path}/{folder}")
    return folder


def keep_pending(spark: SparkSession, path: str, folder: str | None) -> None:
    """Name the folder of waiting rows, or none; the one before goes."""
    before = (files.read_document(spark, f"{path}/current.json") or {}).get("folder")
    if before == folder:
        return
    files.write_document(spark, f"{path}/current.json", {"folder": folder})
    if before:
        files.delete_folder(spark, f"{path}/{before}")
