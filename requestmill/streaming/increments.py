"""The increment as a stream: landed files become batches, batches are merged."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from requestmill import schemas as S
from requestmill.operators import clean, dedup, rejects
from requestmill.plans.increment import RunConfig, process
from requestmill.session import session_conf, use_utc
from requestmill.sources import files, landing, state

# Copies and restores keep old file times, so no file may be too old to be read. The log of
# files that were read grows in turn; move or delete landed files by ``cleanSource``.
MAX_FILE_AGE = "36500d"


@dataclass(frozen=True)
class StreamConfig:
    """``interval`` None means: take what has landed, then stop.

    Late rows, older than the mark, are merged unless ``drop_late``; the mark
    only ever moves forward. Files of any age are read unless ``max_file_age`` is less.
    ``clean_source`` ("archive" with an ``archive`` folder, or "delete") keeps the log
    of read files short.
    """

    name: str = "requests"
    interval: str | None = "1 minute"
    files_per_batch: int | None = None
    drop_late: bool = False
    run_ts: datetime | None = None
    max_file_age: str = MAX_FILE_AGE
    clean_source: str | None = None
    archive: str | None = None


def read_stream(
    spark: SparkSession,
    config: RunConfig,
    files_per_batch: int | None = None,
    stream: StreamConfig = StreamConfig(),
) -> DataFrame:
    """Landed files as a stream, oldest first."""
    reader = spark.readStream.schema(config.landing_schema()).format(config.landing_format)
    reader = reader.option("maxFileAge", stream.max_file_age)
    if stream.clean_source:
        reader = reader.option("cleanSource", stream.clean_source)
        if stream.archive:
            reader = reader.option("sourceArchiveDir", stream.archive)
    if config.landing_format == "csv":
        reader = reader.options(**{**landing.CSV_OPTIONS, "multiLine": "true"})
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(config.landing)
    return rows.select("*", F.col("_metadata.file_path").alias(rejects.SOURCE))


def stream_increments(
    spark: SparkSession, config: RunConfig, stream: StreamConfig = StreamConfig()
) -> StreamingQuery:
    """Start the stream. Batches run one at a time and may be replayed.

    A replayed batch writes the same run again: the staging folder and ledger
    entry are replaced, and the merge of the same rows changes nothing. Rows from the future
    wait for a later batch.
    """
    use_utc(spark)
    source = read_stream(spark, config, stream.files_per_batch, stream)
    if not config.order:
        source = landing.with_file_place(source)

    def apply(batch: DataFrame, epoch: int) -> None:
        session = use_utc(batch.sparkSession)
        rows = batch if config.order else landing.with_row_place(batch)
        rows = clean.parse_timestamps(rows, ("created_date", "closed_date"))
        run_ts = stream.run_ts or datetime.now(UTC).replace(tzinfo=None)
        latest = run_ts + config.future_margin
        rows = rejects.with_reason(rows, S.RAW_COLUMNS, latest, undated=stream.drop_late)
        if stream.drop_late:
            mark = state.load_mark(session, config.state_path)
            if mark:
                bound = F.lit(mark.replace("T", " ")).cast("timestamp")
                rows = rows.where(
                    (F.col("created_date") >= bound) | F.col(rejects.REASON).isNotNull()
                )
        run_id = f"{stream.name}-{epoch:012d}"
        process(session, config, rows, run_id, run_ts, hold_future=True)

    writer = (
        source.writeStream.queryName(stream.name)
        .option("checkpointLocation", f"{config.root}/checkpoints/{stream.name}")
        .foreachBatch(apply)
    )
    trigger = {"processingTime": stream.interval} if stream.interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_first_of_each_key(
    spark: SparkSession,
    config: RunConfig,
    target: str,
    interval: str | None = "1 minute",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append-only variant: the first row of each key, written once and never changed.

    First is the smallest arrival order within a batch, and the earlier batch of two. Rows
    of any age, and without a creation time, count. A frequent key costs one row for each
    reading task. A batch's keys are looked up in the key column of what was written, which
    is sorted by key and has bloom filters; few keys are named in the scan, more are bounded. A replayed
    batch replaces its own folder. Rows that cannot be read go to ``rejects``.
    """
    use_utc(spark)
    source = read_stream(spark, config, files_per_batch)
    if not config.order:
        source = landing.with_file_place(source)

    def apply(batch: DataFrame, epoch: int) -> None:
        session = use_utc(batch.sparkSession)
        rows = batch if config.order else landing.with_row_place(batch)
        rows = clean.parse_timestamps(rows, ("created_date", "closed_date"))
        staging = f"{config.root}/staging/first-{epoch:012d}"
        rejects.with_reason(rows, S.RAW_COLUMNS, undated=False).write.mode("overwrite").parquet(
            staging
        )
        marked = session.read.parquet(staging)
        refused = rejects.rejected(marked)
        if not refused.isEmpty():
            refused.write.mode("overwrite").parquet(f"{config.rejects_path}/run=first-{epoch:012d}")
        first = dedup.dedup_first(rejects.taken(marked), (config.arrival,))
        own = f"batch={epoch:012d}"
        first = _not_in(first, _batches(session, target, own))
        first.sortWithinPartitions(S.KEY).write.mode("overwrite").option(
            f"parquet.bloom.filter.enabled#{S.KEY}", "true"
        ).parquet(f"{target}/{own}")
        files.delete_folder(session, staging)

    writer = source.writeStream.option(
        "checkpointLocation", f"{config.root}/checkpoints/first-of-key"
    ).foreachBatch(apply)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state"
    ".RocksDBStateStoreProvider"
}
ARRIVED, REFUSED = "_arrived", "_refused"
LISTED_KEYS = 500  # keys up to this number are pushed to the scan one by one


@dataclass(frozen=True)
class StateConfig:
    """How long the state store holds a key, and what is certain about keys.

    span: keys are held in windows of this length by the time they arrive, and forgotten when their
        window is over. A batch costs what it holds and what the state holds, not the history.
    keys_move: whether rows of one key may have different creation times. If not, a row created
        in the running window cannot have come before it. If they may, every key that is new to its
        window is looked up in all that was written.
    clock: when a row arrives; the time of its batch unless a column is given. It has to be the same for a
        whole batch, and later for later ones.
    """

    span: str = "30 days"
    keys_move: bool = False
    clock: Column | None = None


def _possible(keys: DataFrame, column: str) -> Column:
    """A condition for the scan: the keys themselves if they are few, else their range."""
    key = F.col(column)
    few = [r[0] for r in keys.select(column).limit(LISTED_KEYS + 1).collect()]
    if len(few) <= LISTED_KEYS:
        inside = key.isin([k for k in few if k is not None])
        return inside | key.isNull() if None in few else inside
    bounds = keys.agg(F.min(key), F.max(key)).first()
    return key.between(*bounds) | key.isNull()


def _not_in(rows: DataFrame, folders: list[str]) -> DataFrame:
    """Rows whose key none of the folders holds. Keys are pushed down, as files are sorted by key and
    have a bloom filter of it."""
    if not folders or rows.isEmpty():
        return rows
    keys = rows.select(S.KEY).distinct()
    seen = rows.sparkSession.read.schema(rows.select(S.KEY).schema).parquet(*folders)
    return dedup.without_keys(rows, seen.where(_possible(keys, S.KEY)))


def _batches(spark: SparkSession, path: str, own: str) -> list[str]:
    names = files.child_names(spark, path)
    return [f"{path}/{n}" for n in names if n.startswith("batch=") and n != own]


def stream_first_by_state(
    spark: SparkSession,
    config: RunConfig,
    target: str,
    interval: str | None = "1 minute",
    files_per_batch: int | None = None,
    held: StateConfig = StateConfig(),
) -> StreamingQuery:
    """``stream_first_of_each_key`` with the keys of the running window in a state store.

    A streaming aggregate keeps the first row of each key and window; rows are reduced to one for
    each key and task before they are shuffled. A key that is new to its window is new at all if
    it was created in that window, before it arrived. Other ones, late and undated rows among them,
    take the exact route: they are looked up in what was written. So is every key among
    those that once came before their creation time. No row is late for the state, as arrival
    only moves forward. A replayed batch finds the state as it was and replaces its own folder.
    Rows of one key that lie in one block of a file, and have no order column, go by all their columns.
    """
    use_utc(spark)
    source = read_stream(spark, config, files_per_batch)
    clock = F.current_timestamp() if held.clock is None else held.clock
    source = source.withColumn(ARRIVED, clock)
    if not config.order:
        source = landing.with_file_place(source)
    rows = clean.parse_timestamps(source, ("created_date", "closed_date"))
    marked = rejects.with_reason(rows, S.RAW_COLUMNS, undated=False)
    # rows that cannot be read have no key: each record is a group of its own
    refused = F.when(F.col(rejects.REASON).isNotNull(), F.xxhash64(rejects.RECORD, rejects.SOURCE))
    columns = [c for c in marked.columns if c != ARRIVED]
    grouped = (
        marked.withWatermark(ARRIVED, "0 seconds")
        .groupBy(F.window(ARRIVED, held.span), F.col(S.KEY).alias("_key"), refused.alias(REFUSED))
        .agg(
            F.min_by(F.struct(*columns), F.struct(ARRIVED, config.arrival, *columns)).alias("first"),
            F.min(ARRIVED).alias("since"),
            F.max(ARRIVED).alias("until"),
        )
    )

    def apply(batch: DataFrame, epoch: int) -> None:
        session = use_utc(batch.sparkSession)
        own = f"batch={epoch:012d}"
        staging, ahead = f"{config.root}/staging/state-{epoch:012d}", f"{config.root}/ahead"
        # groups that an earlier batch began have been written
        new = batch.where(F.col("since") == F.col("until"))
        new.select("first.*", F.col("window.start").alias("_start"), F.col("until").alias("_now")).write.mode(
            "overwrite"
        ).parquet(staging)
        marked = session.read.parquet(staging)
        if marked.isEmpty():  # a batch that only ends windows
            files.delete_folder(session, staging)
            return
        bad = rejects.rejected(marked)
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{config.rejects_path}/run=state-{epoch:012d}")
        taken = rejects.taken(marked)
        created = F.col("created_date")
        certain = created.between(F.col("_start"), F.col("_now")) & F.lit(not held.keys_move)
        certain = F.coalesce(certain, F.lit(False))
        own_window = _not_in(taken.where(certain), _batches(session, ahead, own))
        looked_up = _not_in(taken.where(~certain), _batches(session, target, own))
        first = own_window.unionByName(looked_up)
        kept = first.drop("_start", "_now")
        kept.sortWithinPartitions(S.KEY).write.mode("overwrite").option(
            f"parquet.bloom.filter.enabled#{S.KEY}", "true"
        ).parquet(f"{target}/{own}")
        early = taken.where(created > F.col("_now")).select(S.KEY)
        if not early.isEmpty():
            early.distinct().sortWithinPartitions(S.KEY).write.mode("overwrite").option(
                f"parquet.bloom.filter.enabled#{S.KEY}", "true"
            ).parquet(f"{ahead}/{own}")
        files.delete_folder(session, staging)

    writer = (
        grouped.writeStream.outputMode("update")
        .option("checkpointLocation", f"{config.root}/checkpoints/first-by-state")
        .foreachBatch(apply)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with session_conf(spark, ROCKSDB):
        return writer.trigger(**trigger).start()
