"""One increment end to end: extract, transform, merge, publish, record, mark.

The order of the sinks is raw master, processed master, publication, ledger, mark.
Each may be repeated: the merges keep one row per key, a publication replaces all
rows, a ledger entry replaces the one of the same run. The mark moves last, so a run
that fails anywhere is read again by the next one.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill import schemas as S
from requestmill.functions import temporal
from requestmill.operators import clean, contract, rejects, reports
from requestmill.plans.transform import TransformOptions, transform
from requestmill.session import use_utc
from requestmill.sources import drift, files, landing, state, tables
from requestmill.sources.master import BROADCAST_BYTES, Layout, Master


@dataclass(frozen=True)
class RunConfig:
    """Where the data lies and what may vary. ``root`` must be a shared folder.

    landed: schema of the landed records, all text or with TIMESTAMP dates.
    order: source column that tells the arrival order; without one, the place in
        the landed files does.
    skip_old_files: leave files unopened that were last written before the
        increment begins, less ``file_time_margin`` for clocks and time zones. Use
        it, or the stream, where the landing zone only grows.
    track_files: read each landed file once, by a ledger of processed files, instead of the whole
        zone in every run. Rows in new files are then taken whatever their age, so ``lookback`` has no
        meaning; only a first or full load begins some days back, and counts what it skips. The way
        to go for landing zones that keep growing.
    arrival_folders: with ``track_files``, list only the zone's new and recent folders; the whole zone now and
        then, and in a full load.
    files_per_run: files that one step reads; more are read in further steps.
    rescue: with ``track_files`` and JSON, count the fields and types of each run's records in ``fields``
        and keep what lies beyond the schema in ``rescued``; the files are read a second time for it.
    future_margin: rows created later than the run by more than this are rejected or, where files
        are read once, wait in ``pending`` until their time has come. The mark never passes the
        run's own time.
    vacuum_grace: seconds that replaced partitions are kept for readers; None keeps all.
    publish: takes the accepted rows of the processed master, for instance
        ``lambda df: refresh_table(df, "requests")``.
    """

    root: str
    landing: str
    landing_format: str = "json"
    landed: T.StructType = field(default_factory=lambda: S.RAW_SCHEMA)
    raw_format: str = "parquet"
    order: str | None = None
    days_back: int = 7
    force_full: bool = False
    lookback: timedelta = timedelta(0)
    skip_old_files: bool = False
    file_time_margin: timedelta = timedelta(days=1)
    track_files: bool = False
    arrival_folders: landing.ArrivalFolders | None = None
    files_per_run: int = 50_000
    rescue: bool = False
    future_margin: timedelta = timedelta(days=1)
    vacuum_grace: float | None = 3600.0
    layout: Layout = field(default_factory=Layout)
    options: TransformOptions = field(default_factory=TransformOptions)
    publish: Callable[[DataFrame], None] | None = None
    broadcast_bytes: int = BROADCAST_BYTES
    keep_staging: bool = False

    @property
    def state_path(self) -> str:
        return f"{self.root}/state.json"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/rejects"

    @property
    def pending_path(self) -> str:
        return f"{self.root}/pending"

    @property
    def fields_path(self) -> str:
        return f"{self.root}/fields"

    @property
    def rescued_path(self) -> str:
        return f"{self.root}/rescued"

    @property
    def listing_path(self) -> str:
        return f"{self.root}/listing.json"

    @property
    def files_path(self) -> str:
        return f"{self.root}/files"

    @property
    def arrival(self) -> str:
        return self.order or landing.ARRIVAL

    def landing_schema(self) -> T.StructType:
        """Raw columns as landed, and the order column as a number when there is one."""
        extra = [T.StructField(self.order, T.LongType())] if self.order else []
        if self.landing_format in ("json", "csv"):
            extra.append(T.StructField(rejects.CORRUPT, T.StringType()))
        return T.StructType([*self.landed.fields, *extra])


def raw_master(spark: SparkSession, config: RunConfig) -> Master:
    return Master(
        spark,
        f"{config.root}/raw",
        S.EXTRACTED_SCHEMA,
        config.layout,
        config.raw_format,
        broadcast_bytes=config.broadcast_bytes,
    )


def processed_master(spark: SparkSession, config: RunConfig) -> Master:
    return Master(
        spark,
        f"{config.root}/processed",
        S.PROCESSED_SCHEMA,
        config.layout,
        broadcast_bytes=config.broadcast_bytes,
        milliseconds=True,
    )


def starting_point(spark: SparkSession, config: RunConfig, run_ts: datetime) -> str:
    """The mark to extract from; some days back on a first or forced full load."""
    mark = None if config.force_full else state.load_mark(spark, config.state_path)
    if mark:
        return mark
    return (run_ts - timedelta(days=config.days_back)).isoformat()


def _bound(config: RunConfig, since: str) -> datetime:
    return datetime.fromisoformat(landing.normalise_since(since)) - config.lookback


def _landed(
    spark: SparkSession, config: RunConfig, since: str, paths: list[str] | None = None
) -> DataFrame:
    early = landing.normalise_since((_bound(config, since) - config.file_time_margin).isoformat())
    raw = landing.read_landing(
        spark,
        config.landing,
        config.landing_format,
        config.landing_schema(),
        modified_after=early if config.skip_old_files else None,
        paths=paths,
    )
    raw = raw.select("*", F.col("_metadata.file_path").alias(rejects.SOURCE))
    return raw if config.order else landing.with_file_place(raw)


def extract(spark: SparkSession, config: RunConfig, since: str) -> DataFrame:
    """The increment from the landing zone, in a shape ready to be staged.

    Rows are numbered after the filter, which so reaches the scan; numbering the
    remaining rows keeps their order.
    """
    raw = _landed(spark, config, since).drop(rejects.CORRUPT, rejects.SOURCE)
    increment = landing.extract_incremental(raw, _bound(config, since).isoformat())
    return increment if config.order else landing.with_row_place(increment)


def extract_marked(
    spark: SparkSession,
    config: RunConfig,
    since: str | None,
    run_ts: datetime,
    paths: list[str] | None = None,
) -> DataFrame:
    """The increment, and beside it the rows that cannot be taken, each with its reason.

    ``since`` None takes rows of any age. Where files are read once, earlier rows stay with a reason, so
    that they can be counted; where the zone is read again they are left to the scan.
    """
    raw = _landed(spark, config, since or run_ts.isoformat(), paths)
    parsed = clean.parse_timestamps(raw, ("created_date", "closed_date"))
    latest = run_ts + config.future_margin
    marked = rejects.with_reason(parsed, S.RAW_COLUMNS, latest)
    if since is not None:
        bound = F.lit(_bound(config, since).isoformat(sep=" ")).cast("timestamp")
        if config.track_files:
            marked = rejects.marked_early(marked, bound)
        else:
            marked = marked.where(
                (F.col("created_date") >= bound) | F.col(rejects.REASON).isNotNull()
            )
    return marked if config.order else landing.with_row_place(marked)


def names_to_list(spark: SparkSession, config: RunConfig, run_ts: datetime) -> list[str] | None:
    """What a run lists of the landing zone; None is all of it."""
    last = files.read_document(spark, config.listing_path)
    if config.arrival_folders is None or config.force_full or last is None:
        return None
    if run_ts - datetime.fromisoformat(last["full_at"]) >= config.arrival_folders.full_every:
        return None
    names = files.child_names(spark, config.landing)
    return config.arrival_folders.recent(names, datetime.fromisoformat(last["listed_at"]))


def _note_listing(spark: SparkSession, config: RunConfig, run_ts: datetime, full: bool) -> None:
    """Note what was listed, once its files have been read. Times never go back."""
    if config.arrival_folders is None:
        return
    last = files.read_document(spark, config.listing_path) or {}
    own = run_ts.isoformat()
    full_at = max(own, last.get("full_at", own)) if full else last["full_at"]
    document = {"listed_at": max(own, last.get("listed_at", own)), "full_at": full_at}
    files.write_document(spark, config.listing_path, document)


def new_files(spark: SparkSession, config: RunConfig, names: list[str] | None = None) -> DataFrame:
    """Landed files that no run has read; one that was written again is new."""
    known = state.processed_files(spark, config.files_path)
    return landing.landed_files(spark, config.landing, names).join(
        known, ["file_path", "file_time", "size_bytes"], "left_anti"
    )


def _with_pending(
    spark: SparkSession, config: RunConfig, increment: DataFrame, run_ts: datetime
) -> DataFrame:
    """The increment and the rows that wait, each of these taken if its time has come."""
    waiting = state.pending_rows(spark, config.pending_path)
    if waiting is None:
        return increment
    latest = run_ts + config.future_margin
    again = rejects.with_reason(waiting, S.RAW_COLUMNS, latest, undated=False)
    return increment.unionByName(again, allowMissingColumns=True)


def process(
    spark: SparkSession,
    config: RunConfig,
    increment: DataFrame,
    run_id: str,
    run_ts: datetime,
    hold_future: bool = False,
) -> dict[str, Any]:
    """Stage an increment, transform it, and bring it to every sink.

    ``hold_future``: rows from the future wait for a later run, for sources that are read once.
    A failure is recorded with the state of every target and raised again.
    """
    if hold_future:
        increment = _with_pending(spark, config, increment, run_ts)
    staging = f"{config.root}/staging/{run_id}"
    entry: dict[str, Any] = {"run_id": run_id, "committed_at": run_ts}
    try:
        return _process(spark, config, increment, entry, staging, hold_future)
    except Exception as error:
        ok = [entry.get(f"{t}_status") == "succeeded" for t in ("raw", "processed")]
        published = False if entry.get("publish_status") == "failed" else None
        entry["status"] = reports.load_status(*ok, published)
        if entry["status"] == "success":
            entry["status"] = "partial"  # something behind the targets failed
        entry["error"] = f"{type(error).__name__}: {error}"[:2000]
        with contextlib.suppress(Exception):  # what is raised is the first failure
            state.append_ledger(spark, config.ledger_path, entry)
        raise
    finally:
        if not config.keep_staging:
            with contextlib.suppress(Exception):
                files.delete_folder(spark, staging)


def _process(
    spark: SparkSession,
    config: RunConfig,
    increment: DataFrame,
    entry: dict[str, Any],
    staging: str,
    hold_future: bool,
) -> dict[str, Any]:
    """Fills ``entry`` step by step, so that it tells how far a failed run came."""
    run_id, run_ts = entry["run_id"], entry["committed_at"]
    if rejects.REASON not in increment.columns:
        increment = rejects.without_reason(increment)
    staged = Observation(f"staging {run_id}")
    reason = F.col(rejects.REASON)
    early = reason.eqNullSafe(rejects.EARLY)
    waits = reason.eqNullSafe(rejects.FUTURE) & F.lit(hold_future)
    increment.observe(
        staged,
        F.count_if(reason.isNull()).alias("raw_count"),
        F.count_if(early).alias("skipped_count"),
        F.count_if(waits).alias("pending_count"),
        F.count_if(reason.isNotNull() & ~early & ~waits).alias("refused_count"),
    ).where(~early).write.mode("overwrite").parquet(f"{staging}/raw")
    counts = staged.get
    raw_count = counts["raw_count"]
    entry |= {c: counts[c] for c in ("pending_count", "skipped_count")}
    marked = spark.read.parquet(f"{staging}/raw")
    entry["rejected_count"] = 0
    if counts["refused_count"]:
        entry["rejected_count"] = _write_rejects(spark, config, marked.where(~waits), run_id)
    pending = None
    if counts["pending_count"]:
        held = marked.where(waits).drop(rejects.REASON, rejects.RECORD)
        pending = state.write_pending(held, config.pending_path, run_id)
    if raw_count == 0:
        if hold_future:
            state.keep_pending(spark, config.pending_path, pending)
        return {**entry, "raw_count": 0, "processed_count": 0, "status": "empty"}
    raw = rejects.taken(marked)
    entry["raw_count"] = raw_count

    options = replace(config.options, order=(config.arrival,), timestamps_as_text=False)
    observed = Observation(f"increment {run_id}")
    latest = temporal.to_iso_seconds(F.max("created_date")).alias("latest")
    transform(raw, run_ts, options).observe(
        observed, *reports.batch_metric_columns(), latest
    ).write.mode("overwrite").parquet(f"{staging}/processed")
    processed = spark.read.parquet(f"{staging}/processed")
    metrics = observed.get

    for target in ("raw_status", "processed_status"):
        entry[target] = "not reached"
    entry["raw_status"] = "failed"
    raw_rows = raw_master(spark, config)
    entry["raw_path"] = raw_rows.merge(raw, order=(config.arrival,)).path
    entry["raw_status"], entry["processed_status"] = "succeeded", "failed"
    master = processed_master(spark, config)
    entry["processed_path"] = master.merge(processed).path
    entry |= {
        "processed_status": "succeeded",
        "processed_count": metrics["processed_count"],
        "avg_quality_score": metrics["avg_quality_score"],
        "records_with_location": metrics["records_with_location"],
    }
    refused_rows = contract.quarantined(contract.mark_violations(processed))
    refused_rows.write.mode("overwrite").parquet(f"{config.quarantine_path}/run={run_id}")
    entry["publish_status"] = "skipped"
    if config.publish is not None:
        entry["publish_status"] = "failed"
        config.publish(contract.accepted(contract.mark_violations(master.read())))
        entry["publish_status"] = "succeeded"
    published = True if config.publish is not None else None
    entry["status"] = reports.load_status(True, True, published)
    state.append_ledger(spark, config.ledger_path, entry)
    if hold_future:
        state.keep_pending(spark, config.pending_path, pending)

    own = metrics["latest"]
    if own:  # a row from the future must not end the reading of later ones
        own = min(own, landing.normalise_since(run_ts.isoformat()))
    marks = [m for m in (state.load_mark(spark, config.state_path), own) if m]
    if marks:
        state.save_mark(spark, config.state_path, max(marks), run_ts)
    if config.vacuum_grace is not None:
        raw_rows.vacuum(config.vacuum_grace)
        master.vacuum(config.vacuum_grace)
    return entry


def _write_rejects(spark: SparkSession, config: RunConfig, marked: DataFrame, run_id: str) -> int:
    """Write the rejects that no other run has written; returns how many these are."""
    rows = rejects.rejected(marked)
    path = config.rejects_path
    if files.path_exists(spark, path):
        known = spark.read.schema(rejects.SCHEMA).parquet(path).where(F.col("run") != run_id)
        rows = rejects.unseen(rows, known)
    new = Observation(f"rejects {run_id}")
    rows.observe(new, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/run={run_id}")
    return new.get["n"]


def run_increment(
    spark: SparkSession,
    config: RunConfig,
    run_ts: datetime | None = None,
    run_id: str | None = None,
) -> dict[str, Any]:
    """One increment from the mark on. An empty one changes nothing."""
    use_utc(spark)
    run_ts = run_ts or datetime.now(UTC).replace(tzinfo=None)
    run_id = run_id or run_ts.strftime("%Y%m%dT%H%M%S%f")
    since: str | None = starting_point(spark, config, run_ts)
    if not config.track_files:
        return process(spark, config, extract_marked(spark, config, since, run_ts), run_id, run_ts)
    if not config.force_full and state.load_mark(spark, config.state_path):
        since = None
    names = names_to_list(spark, config, run_ts)
    entry = _run_new_files(spark, config, since, run_ts, run_id, names)
    _note_listing(spark, config, run_ts, names is None)
    return entry


def _run_new_files(
    spark: SparkSession,
    config: RunConfig,
    since: str | None,
    run_ts: datetime,
    run_id: str,
    names: list[str] | None,
) -> dict[str, Any]:
    """Read files that no run has read, or all of them, oldest first and some at a time.

    The list is written before it is used, so every step sees the same files. Names reach the
    driver for one step only. The returned entry is the last step's, with the counts of all.
    """
    full = config.force_full
    found = landing.landed_files(spark, config.landing) if full else new_files(spark, config, names)
    listing = f"{config.root}/staging/{run_id}-files"
    found.write.mode("overwrite").parquet(listing)
    ordered = spark.read.schema(found.schema).parquet(listing).orderBy("file_time", "file_path")
    entry: dict[str, Any] = {"run_id": run_id, "raw_count": 0, "processed_count": 0, "status": "empty"}
    added = ("raw_count", "processed_count", "rejected_count", "skipped_count")
    step = 0
    try:
        while True:
            fresh = ordered.offset(step * config.files_per_run).limit(config.files_per_run).collect()
            if not fresh:
                waiting = state.pending_rows(spark, config.pending_path)
                if step or waiting is None:
                    return entry
                # nothing has landed, but rows that wait may have come of age
                nothing = rejects.without_reason(waiting.where("false"))
                return process(spark, config, nothing, run_id, run_ts, hold_future=True)
            own = f"{run_id}-{step + 1}" if step else run_id
            paths = [f.file_path for f in fresh]
            marked = extract_marked(spark, config, since, run_ts, paths)
            done = process(spark, config, marked, own, run_ts, hold_future=True)
            if config.rescue:
                _rescue(spark, config, paths, own)
            state.record_files(spark, config.files_path, spark.createDataFrame(fresh, found.schema), own)
            sums = {c: (entry.get(c) or 0) + (done.get(c) or 0) for c in added}
            if done["status"] == "empty" and entry["status"] != "empty":
                done = {**done, "status": entry["status"]}
            entry = {**entry, **done, **sums}
            step += 1
            if len(fresh) < config.files_per_run:
                return entry
    finally:
        with contextlib.suppress(Exception):
            files.delete_folder(spark, listing)


def _rescue(spark: SparkSession, config: RunConfig, paths: list[str], run_id: str) -> None:
    """What the files hold beyond the schema; the same run again replaces it."""
    if config.landing_format != "json":
        raise ValueError("fields are rescued from JSON only")
    known = T.StructType([f for f in config.landing_schema() if f.name != rejects.CORRUPT])
    lines = drift.landed_lines(spark, config.landing, paths)
    counts = drift.field_counts(drift.as_records(lines), known)
    counts.coalesce(1).write.mode("overwrite").parquet(f"{config.fields_path}/run={run_id}")
    rows = drift.with_rescued(lines, known).where(F.col(drift.RESCUED).isNotNull())
    rows.select("file", S.KEY, drift.RESCUED).write.mode("overwrite").parquet(
        f"{config.rescued_path}/run={run_id}"
    )


def drift_report(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Fields, types and counts of the records of all runs that rescued."""
    schema = f"{drift.REPORT}, run string"
    return drift.summed(spark.read.schema(schema).parquet(config.fields_path))


def load_batch(
    spark: SparkSession, config: RunConfig, raw: DataFrame, run_ts: datetime, run_id: str
) -> dict[str, Any]:
    """Load a given raw batch whole, whatever the mark says, and return its record."""
    extracted = clean.parse_timestamps(raw, ("created_date", "closed_date"))
    return process(use_utc(spark), config, extracted, run_id, run_ts)


def run_record(spark: SparkSession, entry: dict[str, Any]) -> DataFrame:
    """The record of a run as a relation of one row."""
    return spark.createDataFrame([[entry.get(n) for n in S.LEDGER_SCHEMA.names]], S.LEDGER_SCHEMA)


def refresh_to(name: str) -> Callable[[DataFrame], None]:
    """A publication: full refresh of a Spark table."""
    return lambda df: tables.refresh_table(df, name)
