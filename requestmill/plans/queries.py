"""Every operator as a runnable query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from requestmill import schemas as S
from requestmill.functions import temporal, text
from requestmill.operators import clean, collated, contract, dedup, incidents, lookup, rejects, reports
from requestmill.plans import increment as runs
from requestmill.plans.rollups import Rollup
from requestmill.plans.sample_data import increments, raw_requests
from requestmill.plans.transform import TransformOptions, parse_and_dedup, transform
from requestmill.session import use_utc, working_folder
from requestmill.sources import drift, landing, state, tables
from requestmill.sources.master import Layout, Master
from requestmill.streaming import increments as streams

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2025-01-02 03:04:05.678901"
SINCE = "2024-01-15 12:00:00.500"
FUTURE, FEBRUARY = "2025-01-25T00:00:00", "2025-02-01 00:00:00"
AS_OF = "2024-01-31T00:00:00"
TIGHT_LIMITS = {"agency": 5, "descriptor": 7}
LEDGER_BATCH = 1000

# Reports that a rollup keeps: the query's name and the method.
ROLLED = {
    "overall_stats": "overall_stats",
    "completeness_report": "completeness",
    "quality_bands": "quality_bands",
    "top_agencies": "top_agencies",
    "data_summary": "data_summary",
    "run_check": "run_check",
    "latest_created": "latest_created",
    "latest_processed_report": "latest_processed",
}

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(use_utc(spark), sf_dir)

    _REGISTRY[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def processed(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return transform(raw_requests(spark, sf_dir), RUN_TS, TransformOptions(carry=carry))


def processed_increments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    options = TransformOptions(carry=("seq", "batch_id"))
    first, second = increments(spark, sf_dir)
    return transform(first, RUN_TS, options), transform(second, RUN_TS, options)


def _land(df: DataFrame, path: str) -> None:
    df.select(*S.RAW_COLUMNS, "seq").write.mode("append").json(path)


# Sources and sinks ----------------------------------------------------------


@query
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landing.extract_incremental(raw_requests(spark, sf_dir), SINCE)
    return found.select("unique_key", "created_date", "closed_date", "agency", "seq")


@query
def incremental_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landing.extract_incremental(raw_requests(spark, sf_dir), SINCE)
    return landing.in_creation_order(found.select("unique_key", "created_date", "seq"))


@query
def since_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_requests(spark, sf_dir)
    spaced = F.translate("created_date", "T", " ")
    return raw.select(
        "seq",
        temporal.normalise_since(F.col("created_date")).alias("since_text"),
        temporal.normalise_since(spaced).alias("since_from_spaced"),
    )


@query
def full_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landing.extract_days_back(raw_requests(spark, sf_dir), AS_OF, 7)
    return found.select("unique_key", "created_date", "seq")


@query
def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "json-landing")
    _land(raw_requests(spark, sf_dir), path)
    schema = T.StructType([*S.RAW_SCHEMA.fields, T.StructField("seq", T.LongType())])
    return landing.read_landing(spark, path, "json", schema)


@query
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.to_json(F.struct(*S.RAW_COLUMNS)).alias("payload")
    payloads = raw_requests(spark, sf_dir).select("seq", record)
    return landing.parse_json_records(payloads, "payload")


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "csv-roundtrip")
    landing.write_csv(raw_requests(spark, sf_dir).select(*S.RAW_COLUMNS), path)
    return landing.read_csv(spark, path)


@query
def csv_documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and letters of all kinds."""
    path = working_folder(spark, "csv-documents")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    landing.write_csv(docs, path)
    return landing.read_csv(spark, path, docs.schema, na_tokens=())


@query
def json_documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "json-documents")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs.write.json(path)
    return landing.read_landing(spark, path, "json", docs.schema)


@query
def parquet_ms_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "parquet-ms")
    tables.write_parquet_ms(processed(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def full_refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created once, refreshed twice: the second refresh replaces every row."""
    location = working_folder(spark, "requests")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    tables.create_table(spark, name, location)
    tables.create_table(spark, name, location)
    rows = contract.accepted(contract.mark_violations(processed(spark, sf_dir)))
    tables.refresh_table(rows, name)
    tables.refresh_table(rows, name)
    return spark.table(name)


@query
def epoch_ns_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other row holds nanoseconds, the rest text."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    nanos = (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 789).cast("string")
    shown = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    mixed = F.when(F.col("event_id") % 2 == 0, nanos).otherwise(shown)
    rows = events.select(F.col("event_id").alias("seq"), mixed.alias("created_date"))
    return clean.convert_epoch_timestamps(rows)


@query
def state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{working_folder(spark, 'state')}/state.json"
    mark = reports.high_water_mark(processed(spark, sf_dir)).first()[0]
    state.save_mark(spark, path, AS_OF, datetime(2025, 1, 1))
    state.save_mark(spark, path, mark, datetime.fromisoformat(RUN_TS))
    return state.read_state(spark, path)


@query
def incident_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = working_folder(spark, "incidents")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    tables.create_table(spark, name, location, S.INCIDENT_SCHEMA, S.INCIDENT_LIMITS, ())
    incidents.as_incidents(raw_requests(spark, sf_dir), RUN_TS).write.insertInto(name)
    return spark.table(name)


# Projections and scalar functions -------------------------------------------


@query
def select_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_requests(spark, sf_dir).drop("descriptor", "status")
    found = clean.select_available(raw.withColumn("unwanted", F.lit(1)), carry=("seq",))
    return clean.add_absent(found, {f.name: f.dataType for f in S.RAW_SCHEMA})


@query
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts in one column: ISO, with an offset, 12 and 24 hours, date only, with and
    without leading zeros, and two compact ones."""
    moment, number = F.col("ts"), F.col("event_id")
    iso = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    shown = F.when(number % 97 == 0, "not-a-date")
    layouts = {
        0: iso,
        1: F.date_format(moment, "MM/dd/yyyy hh:mm:ss a"),
        2: F.concat(iso, F.lit("-05:00")),
        3: F.date_format(moment, "MM/dd/yyyy"),
        4: F.date_format(moment, "M/d/yyyy h:mm:ss a"),
        5: F.date_format(moment, "M/d/yyyy H:mm:ss"),
        6: F.date_format(moment, "M/d/yyyy"),
        7: F.date_format(moment, "yyyyMMdd"),
    }
    for remainder, layout in layouts.items():
        shown = shown.when(number % 9 == remainder, layout)
    shown = shown.otherwise(F.date_format(moment, "yyyy/MM/dd"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return clean.parse_timestamps(
        events.select(number.alias("seq"), shown.alias("created_date"), shown.alias("due_date"))
    )


@query
def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, padded and exponent numbers are read; suffixes and ``nan`` are not."""
    latitude, place = F.col("latitude"), F.col("seq") % 5
    shown = (
        F.when(place == 0, latitude)
        .when(place == 1, F.concat(F.lit("  "), latitude, F.lit("\t")))
        .when(place == 2, F.concat(latitude, F.lit("e0")))
        .when(place == 3, F.concat(latitude, F.lit("d")))
        .otherwise("nan")
    )
    raw = raw_requests(spark, sf_dir).select("seq", shown.alias("latitude"), "longitude")
    return clean.parse_numbers(raw)


@query
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_requests(spark, sf_dir).select("seq", "latitude", "longitude")
    return clean.clean_coordinates(raw)


@query
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalise_text(raw_requests(spark, sf_dir).select("seq", *S.TEXT_COLUMNS))


@query
def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.category_lookup(raw_requests(spark, sf_dir).select("seq", "borough"))


@query
def collated_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boroughs of raw records, some in lower case and some with blanks at the end, by their collation."""
    text = F.when(F.col("seq") % 3 == 0, F.lower("borough")).otherwise(F.col("borough"))
    text = F.when(F.col("seq") % 4 == 0, F.concat(text, F.lit("  "))).otherwise(text)
    raw = raw_requests(spark, sf_dir).select(text.alias("borough"))
    return collated.value_counts(raw, "borough")


@query
def category_lookup_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users replaced by the names of customers: the mapping sent to all tasks, and shuffled."""
    key = F.concat(F.lit("user "), F.col("c_custkey").cast("string"))
    pairs = _table(spark, sf_dir, "customer").select(key.alias("key"), F.col("c_name").alias("value"))
    mapping = lookup.checked(pairs)
    raw = raw_requests(spark, sf_dir).select("seq", "descriptor")
    ways = {"broadcast": lookup.BROADCAST_BYTES, "shuffle": 0}
    found = [
        lookup.look_up(raw, "descriptor", mapping, size).withColumn("way", F.lit(way))
        for way, size in ways.items()
    ]
    return found[0].unionByName(found[1])


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_requests(spark, sf_dir)
    return clean.parse_timestamps(raw.select("seq", "created_date", "closed_date"))


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.add_date_parts(_dated(spark, sf_dir)).drop("closed_date")


@query
def resolution_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.add_resolution_hours(_dated(spark, sf_dir)).select("seq", "resolution_hours")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps up to the flags on every raw row, duplicates included."""
    return (
        raw_requests(spark, sf_dir)
        .transform(clean.parse_timestamps)
        .transform(clean.clean_coordinates)
        .transform(clean.normalise_text)
        .transform(clean.add_date_parts)
        .transform(clean.add_resolution_hours)
        .transform(clean.add_status_flags)
    )


@query
def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("seq", "is_closed", "has_location")


@query
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill_missing(_flagged(spark, sf_dir))


@query
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = clean.fill_missing(_flagged(spark, sf_dir))
    return clean.add_quality_score(filled).select("seq", "data_quality_score")


@query
def drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_requests(spark, sf_dir).select("seq", "agency", "descriptor", "borough")
    return clean.drop_empty_rows(raw, ("agency", "descriptor", "borough"))


@query
def format_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = clean.stamp(_dated(spark, sf_dir), RUN_TS)
    return clean.format_timestamps(stamped)


@query
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text timestamps with ``''``, ``NaT`` and ``None`` among them, read back."""
    number = F.col("seq")
    shown = clean.format_timestamps(_dated(spark, sf_dir)).withColumn(
        "created_date",
        F.when(number % 5 == 0, "NaT").when(number % 5 == 1, "None").otherwise(F.col("created_date")),
    )
    return clean.restore_timestamps(shown)


@query
def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing-value texts count as NULL only as they stand, not inside blanks."""
    tokens = F.array(*[F.lit(t) for t in S.NA_TOKENS])
    token = F.element_at(tokens, (F.col("seq") % len(S.NA_TOKENS) + 1).cast("int"))
    shown = (
        F.when(F.col("seq") % 3 == 0, token)
        .when(F.col("seq") % 3 == 1, F.concat(F.lit(" "), token))
        .otherwise(F.col("complaint_type"))
    )
    raw = raw_requests(spark, sf_dir).select("seq", shown.alias("complaint_type"))
    return clean.null_na_tokens(raw)


@query
def canonical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = raw_requests(spark, sf_dir).select(*sorted(S.RAW_COLUMNS), "seq")
    return clean.canonical_columns(shuffled.drop("descriptor"))


@query
def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled, case-insensitive and preview expressions on the raw text."""
    raw = raw_requests(spark, sf_dir)
    blank = F.when(F.col("seq") % 3 == 0, F.lit("   ")).otherwise(F.col("borough"))
    return raw.select(
        "seq",
        text.is_filled(blank).alias("borough_filled"),
        text.equals_ignoring_case(F.col("status"), "CLOSED").alias("closed"),
        text.preview(F.coalesce("descriptor", F.lit("")), 5).alias("descriptor_preview"),
    )


@query
def transform_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir)


@query
def transform_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform with timestamps as text."""
    options = TransformOptions(timestamps_as_text=True)
    return transform(raw_requests(spark, sf_dir), RUN_TS, options)


# Duplicates and merge -------------------------------------------------------


@query
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_first(raw_requests(spark, sf_dir))


@query
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_counts(raw_requests(spark, sf_dir))


@query
def merge_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.merge_keep_last(*increments(spark, sf_dir))


@query
def merge_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.merge_anti_join(*increments(spark, sf_dir))


@query
def merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = increments(spark, sf_dir)
    return dedup.merge_keep_last(dedup.merge_keep_last(first, second), second)


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = increments(spark, sf_dir)
    return dedup.union_by_name(first.drop("descriptor"), second)


@query
def append_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = increments(spark, sf_dir)
    return dedup.merge_keep_last(first.drop("unique_key"), second.drop("unique_key"))


@query
def merge_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = dedup.merge_keep_last(*processed_increments(spark, sf_dir))
    return merged.drop("seq", "batch_id")


def _merged_master(spark: SparkSession, sf_dir: str, layout: Layout) -> DataFrame:
    """Both increments through a master dataset, the second one twice."""
    root = working_folder(spark, "master")
    master = Master(spark, f"{root}/processed", S.PROCESSED_SCHEMA, layout, milliseconds=True)
    for number, batch in enumerate(increments(spark, sf_dir)):
        staged = f"{root}/staged/{number}"
        transform(batch, RUN_TS).write.parquet(staged)
        for _ in range(number + 1):
            master.merge(spark.read.parquet(staged))
    return master.read()


@query
def merge_without_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increments with repeated keys and no order, with and without a broadcast: of one key the
    row that is last by its columns stays, and both ways give the same rows."""
    root = working_folder(spark, "unordered")
    columns = ("unique_key", "created_date", "status", "seq")
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in columns[:3]] + [T.StructField("seq", T.LongType())]
    )
    found = []
    for name, size in (("union", 0), ("join", 64 << 20)):
        layout = Layout("buckets", buckets=4)
        master = Master(spark, f"{root}/{name}", schema, layout, broadcast_bytes=size)
        for batch in increments(spark, sf_dir):
            master.merge(batch.select(*columns))
        found.append(master.read().withColumn("way", F.lit(name)))
    return found[0].unionByName(found[1])


@query
def merge_master_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_master(spark, sf_dir, Layout("time"))


@query
def merge_master_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_master(spark, sf_dir, Layout("buckets", buckets=8))


# Reports --------------------------------------------------------------------


def _report(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """Register a report over the processed relation."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(processed(use_utc(spark), sf_dir))

    _REGISTRY[name] = run


for _name, _build in {
    "total_rows": reports.total_rows,
    "overall_stats": reports.overall_stats,
    "completeness_report": reports.completeness,
    "quality_bands": reports.quality_bands,
    "top_agencies": reports.top_agencies,
    "date_range": reports.date_range,
    "data_summary": reports.data_summary,
    "quality_summary": reports.quality_summary,
    "closed_summary": reports.closed_summary,
    "column_stats": reports.column_stats,
    "run_check": reports.run_check,
    "avg_quality": reports.average_quality,
    "null_census": reports.null_census,
    "high_water_mark": reports.high_water_mark,
    "latest_created": reports.latest_created,
    "latest_processed_report": reports.latest_processed,
}.items():
    _report(_name, _build)


@query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.column_profile(processed(spark, sf_dir, carry=("seq",)))


@query
def transform_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.transform_summary(raw_requests(spark, sf_dir), processed(spark, sf_dir))


@query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.batch_metrics(raw_requests(spark, sf_dir), processed(spark, sf_dir))


@query
def cleaning_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cleaning_counts(parse_and_dedup(raw_requests(spark, sf_dir)))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger with one entry per thousand raw rows, written and read back."""
    raw = clean.parse_timestamps(raw_requests(spark, sf_dir))
    number = F.call_function("div", F.col("seq"), F.lit(LEDGER_BATCH))
    entries = (
        raw.groupBy(number.alias("batch"))
        .agg(
            F.count("*").alias("raw_count"),
            F.count_if(F.col("created_date").isNotNull()).alias("processed_count"),
            F.max("created_date").alias("committed_at"),
        )
        .withColumns(
            {
                "run_id": F.concat(F.lit("run-"), F.lpad(F.col("batch").cast("string"), 12, "0")),
                "status": F.lit(reports.load_status(True, True, None)),
            }
        )
    )
    path = working_folder(spark, "ledger")
    types = {f.name: f.dataType for f in S.LEDGER_SCHEMA}
    clean.add_absent(entries, types).select(*types).write.parquet(path)
    return state.read_ledger(spark, path)


@query
def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ledger_report(_ledger(spark, sf_dir))


@query
def recent_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = reports.recent_batches(_ledger(spark, sf_dir))
    return latest.select("run_id", "raw_count", "processed_count", "status")


@query
def state_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{working_folder(spark, 'state')}/state.json"
    mark = reports.high_water_mark(processed(spark, sf_dir)).first()[0]
    state.save_mark(spark, path, mark, datetime.fromisoformat(RUN_TS))
    return reports.state_report(state.read_state(spark, path), _ledger(spark, sf_dir))


# Contract -------------------------------------------------------------------


@query
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments put together without the merge break the key's uniqueness."""
    return contract.contract_violations(
        dedup.union_by_name(*processed_increments(spark, sf_dir))
    )


@query
def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_violations(processed(spark, sf_dir), limits=TIGHT_LIMITS)


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = contract.mark_violations(processed(spark, sf_dir), limits=TIGHT_LIMITS)
    return contract.quarantined(marked).select("unique_key", "created_date", "violations")


@query
def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.schema_contract(processed(spark, sf_dir))


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check on a relation with a column missing and one too many."""
    return contract.schema_contract(processed(spark, sf_dir, carry=("seq",)).drop("status"))


# The same operators on other tables ------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def orders_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return reports.completeness(
        _table(spark, sf_dir, "orders"), columns, nonblank=("o_orderstatus", "o_orderpriority")
    )


@query
def orders_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_agencies(_table(spark, sf_dir, "orders"), 10, "o_custkey")


@query
def orders_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_created(
        _table(spark, sf_dir, "orders"),
        25,
        ("o_orderkey", "o_custkey", "o_orderstatus"),
        "o_orderdate",
        "o_orderkey",
    )


@query
def lineitem_first_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    return dedup.dedup_first(lines, ("l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey")


@query
def lineitem_duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_counts(_table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def events_last_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return dedup.dedup_last(events, ("event_id",), "user_id")


@query
def documents_length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length limits on whole texts."""
    return contract.contract_violations(
        _table(spark, sf_dir, "documents"),
        "doc_id",
        ("doc_id", "lang"),
        {"text": 2000, "source": 4, "lang": 2},
    )


@query
def conversations_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole turns without the blanks around them; missing-value texts become NULL."""
    turns = _table(spark, sf_dir, "conversations")
    stripped = turns.withColumn("text", text.strip_blanks(F.col("text")))
    return clean.null_na_tokens(stripped, columns=("text",))


# Whole runs -----------------------------------------------------------------


@query
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw batch through every sink, and the record of it."""
    root = working_folder(spark, "load")
    name = root.rsplit("/", 1)[1].replace("-", "_")
    tables.create_table(spark, name, f"{root}/requests")
    config = runs.RunConfig(
        root, f"{root}/landing", order="seq", publish=runs.refresh_to(name)
    )
    moment = datetime.fromisoformat(RUN_TS)
    entry = runs.load_batch(spark, config, raw_requests(spark, sf_dir), moment, "load-1")
    return runs.run_record(spark, entry).drop("raw_path", "processed_path")


@query
def run_record_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a merge and a publication that raised, and a run that went well."""
    root = working_folder(spark, "failed")
    moment = datetime.fromisoformat(RUN_TS)
    raw = raw_requests(spark, sf_dir)

    def fail(_: DataFrame) -> None:
        raise OSError("target gone")

    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    other = Layout("buckets", buckets=3)
    Master(spark, f"{root}/processed", S.PROCESSED_SCHEMA, other).merge(
        transform(raw, RUN_TS).limit(0)
    )
    for run_id, broken in (("1-merge", config), ("2-publish", None)):
        if broken is None:
            broken = replace(config, root=f"{root}/second", publish=fail)
        try:
            runs.load_batch(spark, broken, raw, moment, run_id)
        except (ValueError, OSError):
            pass
    runs.load_batch(spark, replace(config, root=f"{root}/second"), raw, moment, "3-good")
    ledger = state.read_ledger(spark, config.ledger_path).unionByName(
        state.read_ledger(spark, f"{root}/second/ledger")
    )
    return ledger.select(
        "run_id",
        "raw_count",
        "processed_count",
        "raw_status",
        "processed_status",
        "publish_status",
        "status",
        F.substring_index("error", ":", 1).alias("error_kind"),
    )


def _land_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").text(path)


@query
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off records, records without a creation time and records from the future, by reason."""
    root = working_folder(spark, "rejects")
    config = runs.RunConfig(root, f"{root}/landing", order="seq", days_back=400)
    _land_lines(_flawed_lines(spark, sf_dir, "2099-01-01T00:00:00").select("value"), config.landing)
    runs.run_increment(spark, config, datetime.fromisoformat(RUN_TS), "run-1")
    return rejects.reject_counts(spark.read.parquet(config.rejects_path).select("reason"))


def _flawed_lines(spark: SparkSession, sf_dir: str, future: str) -> DataFrame:
    """(seq, value): raw records as JSON, some of them cut off, undated or from the future."""
    raw = raw_requests(spark, sf_dir)
    dated = F.when(F.col("seq") % 101 == 0, future).otherwise(F.col("created_date"))
    record = F.to_json(F.struct(*S.RAW_COLUMNS, "seq"))
    cut = F.when(F.col("seq") % 89 == 0, F.substring(record, 1, 20)).otherwise(record)
    return raw.withColumn("created_date", dated).select("seq", cut.alias("value"))


def _run_counts(spark: SparkSession, config: runs.RunConfig) -> DataFrame:
    counts = ("raw_count", "rejected_count", "pending_count", "skipped_count")
    return state.read_ledger(spark, config.ledger_path).select("run_id", *counts)


@query
def three_runs_of_a_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole zone three times: rejects count once, rows from the future come when it is their time."""
    root = working_folder(spark, "same-zone")
    config = runs.RunConfig(root, f"{root}/landing", order="seq", days_back=400)
    _land_lines(_flawed_lines(spark, sf_dir, FUTURE).select("value"), config.landing)
    for n, moment in enumerate((RUN_TS, RUN_TS, FEBRUARY), start=1):
        runs.run_increment(spark, config, datetime.fromisoformat(moment), f"run-{n}")
    return _run_counts(spark, config)


@query
def three_runs_of_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file once: what the first run skips is counted, rows from the future wait."""
    root = working_folder(spark, "new-files")
    config = runs.RunConfig(root, f"{root}/landing", order="seq", days_back=360, track_files=True)
    lines = _flawed_lines(spark, sf_dir, FUTURE)
    for n, moment in enumerate((RUN_TS, "2025-01-20 00:00:00", FEBRUARY)):
        part = lines.where(F.col("seq") % 3 == n).select("value")
        _land_lines(part, f"{config.landing}/arrival_date=2025-01-0{n + 1}")
        runs.run_increment(spark, config, datetime.fromisoformat(moment), f"run-{n + 1}")
    return _run_counts(spark, config)


@query
def runs_over_arrival_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each run took: a file late in an old folder is found by the next listing of all folders."""
    root = working_folder(spark, "arrival-folders")
    folders = landing.ArrivalFolders(look_back=timedelta(days=1), full_every=timedelta(days=10))
    config = runs.RunConfig(
        root, f"{root}/landing", order="seq", days_back=400, track_files=True, arrival_folders=folders
    )
    raw = raw_requests(spark, sf_dir)
    # (landings of a run, as folder day and share of the rows; day of the run)
    plan = (([(1, 0)], 1), ([(5, 1)], 5), ([(1, 2), (4, 3), (6, 4)], 6), ([], 12))
    for n, (landings, day) in enumerate(plan, start=1):
        for folder_day, share in landings:
            part = raw.where(F.col("seq") % 5 == share).coalesce(1)
            _land(part, f"{config.landing}/arrival_date=2025-01-{folder_day:02d}")
        runs.run_increment(spark, config, datetime(2025, 1, day, 12), f"run-{n}")
    known = state.processed_files(spark, config.files_path)
    day = F.regexp_extract("file_path", r"arrival_date=([0-9-]+)/", 1).alias("folder_day")
    taken = known.groupBy("run_id", day).agg(F.count("*").alias("n_files"))
    counts = state.read_ledger(spark, config.ledger_path).select("run_id", "raw_count")
    return taken.join(counts, "run_id")


def _tracked(spark: SparkSession, sf_dir: str, **more) -> runs.RunConfig:
    """Three landings, a run after each; every run reads the new files only."""
    root = working_folder(spark, "tracked")
    config = runs.RunConfig(
        root, f"{root}/landing", order="seq", days_back=400, track_files=True, **more
    )
    raw = raw_requests(spark, sf_dir)
    for n in range(3):
        part = raw.where(F.col("seq") % 3 == n).coalesce(1)
        _land(part, f"{config.landing}/arrival_date=2025-01-0{n + 1}")
        runs.run_increment(spark, config, datetime.fromisoformat(RUN_TS), f"run-{n}")
    return config


@query
def processed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of files: how many, how many a run read, and the arrival folders of the report."""
    config = _tracked(spark, sf_dir)
    known = state.processed_files(spark, config.files_path)
    report = reports.processed_files_report(known)
    day = r"arrival_date=([0-9-]+)/"
    per_run = known.agg(F.count_distinct("run_id").alias("n_runs"))
    return report.join(per_run).select(
        "n_files",
        "n_runs",
        F.regexp_extract("first_file", day, 1).alias("first_day"),
        F.regexp_extract("last_file", day, 1).alias("last_day"),
        F.size("last_files").cast("long").alias("n_listed"),
    )


@query
def increment_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the runs that read new files only have merged."""
    return runs.processed_master(spark, _tracked(spark, sf_dir)).read()


@query
def publish_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published by three runs, each of which replaces it in one step."""
    location = working_folder(spark, "published")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    tables.create_table(spark, name, location)
    _tracked(spark, sf_dir, publish=runs.refresh_to(name))
    return spark.table(name)


@query
def increment_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings and two runs; the second one starts from the first one's mark."""
    root = working_folder(spark, "runs")
    config = runs.RunConfig(root, f"{root}/landing", order="seq", days_back=400)
    raw = raw_requests(spark, sf_dir)
    middle = F.lit("2024-01-15T12:00:00")
    moment = datetime.fromisoformat(RUN_TS)
    _land(raw.where(F.col("created_date") < middle), config.landing)
    runs.run_increment(spark, config, moment, "run-1")
    _land(raw.where(F.col("created_date") >= middle), config.landing)
    runs.run_increment(spark, config, moment, "run-2")
    return runs.processed_master(spark, config).read()


@query
def stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments land one after the other; the stream merges each as it comes."""
    root = working_folder(spark, "stream")
    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    stream = streams.StreamConfig(interval=None, run_ts=datetime.fromisoformat(RUN_TS))
    for batch in increments(spark, sf_dir):
        _land(batch, config.landing)
        streams.stream_increments(spark, config, stream).awaitTermination()
    return runs.processed_master(spark, config).read()


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings; of each key the first row of the first landing that has it."""
    root = working_folder(spark, "stream-first")
    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    target = f"{root}/first"
    for batch in increments(spark, sf_dir):
        _land(batch, config.landing)
        streams.stream_first_of_each_key(spark, config, target, interval=None).awaitTermination()
    return spark.read.parquet(target).drop("batch")


@query
def stream_dedup_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings and a third that repeats the first; keys are held in a state store."""
    root = working_folder(spark, "stream-state")
    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    target = f"{root}/first"
    first, second = increments(spark, sf_dir)
    held = streams.StateConfig(span="3650 days")
    for batch in (first, second, first.where("seq % 3 = 0")):
        _land(batch, config.landing)
        streams.stream_first_by_state(spark, config, target, None, held=held).awaitTermination()
    return spark.read.parquet(target).drop("batch")


@query
def stream_dedup_past_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every window is over before the next batch: all keys take the exact route."""
    root = working_folder(spark, "stream-past")
    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    target = f"{root}/first"
    held = streams.StateConfig(span="1 second")
    for batch in increments(spark, sf_dir):
        _land(batch, config.landing)
        streams.stream_first_by_state(spark, config, target, None, held=held).awaitTermination()
    return spark.read.parquet(target).drop("batch")


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the time lands first; the rows of the earlier half are merged all the same."""
    root = working_folder(spark, "stream-late")
    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    stream = streams.StreamConfig(interval=None, run_ts=datetime.fromisoformat(RUN_TS))
    raw = raw_requests(spark, sf_dir)
    late = F.coalesce(F.col("created_date") < "2024-01-15T12:00:00", F.lit(False))
    for batch in (raw.where(~late), raw.where(late)):
        _land(batch, config.landing)
        streams.stream_increments(spark, config, stream).awaitTermination()
    return runs.processed_master(spark, config).read().select("unique_key", "created_date", "agency")


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose publication fails, and the same batch again after a restart."""
    root = working_folder(spark, "stream-replay")
    config = runs.RunConfig(root, f"{root}/landing", order="seq")
    stream = streams.StreamConfig(interval=None, run_ts=datetime.fromisoformat(RUN_TS))
    _land(raw_requests(spark, sf_dir), config.landing)

    def fail(_: DataFrame) -> None:
        raise OSError("target gone")

    try:
        broken = replace(config, publish=fail)
        streams.stream_increments(spark, broken, stream).awaitTermination()
    except StreamingQueryException:
        pass
    streams.stream_increments(spark, config, stream).awaitTermination()
    return runs.processed_master(spark, config).read()


# Reports kept by parts --------------------------------------------------------


def _rollup(spark: SparkSession, sf_dir: str) -> Rollup:
    """Parts refreshed after each of three merges, the last of which moves rows to other days."""
    root = working_folder(spark, "rollup")
    master = Master(spark, f"{root}/processed", S.PROCESSED_SCHEMA, Layout("time"))
    rollup = Rollup(master, f"{root}/rollup")
    first, second = increments(spark, sf_dir)
    dated = F.to_timestamp("created_date")
    moved = F.date_format(dated + F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    third = first.where("seq % 4 = 0 AND try_to_timestamp(created_date) IS NOT NULL")
    third = third.withColumns({"created_date": moved, "batch_id": F.lit(3)})
    for number, batch in enumerate((first, second, third)):
        staged = f"{root}/staged/{number}"
        transform(batch, RUN_TS).write.parquet(staged)
        master.merge(spark.read.parquet(staged))
        rollup.refresh()
    return rollup


def _rolled(name: str, report: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_rollup(spark, sf_dir), report)()

    run.__name__ = f"rolled_{name}"
    query(run)


for _name, _method in ROLLED.items():
    _rolled(_name, _method)


# Fields beyond the schema -------------------------------------------------------


def _wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, value): raw records as JSON with fields that the schema does not have, one of two types."""
    raw = raw_requests(spark, sf_dir)
    base, seq = F.to_json(F.struct(*S.RAW_COLUMNS)), F.col("seq")

    def field(n: int, name: str, value):
        return F.when(seq % n == 0, F.concat(F.lit(f',"{name}":'), value)).otherwise("")

    extra = F.concat(
        field(5, "channel", F.format_string('"c%d"', seq % 3)),
        field(7, "priority", F.when(seq % 2 == 0, '"high"').otherwise((seq % 10).cast("string"))),
        field(11, "geo", F.format_string('{"cell":[%d,%d]}', seq % 4, seq % 6)),
        F.lit("}"),
    )
    return raw.select("seq", F.concat(F.substring(base, F.lit(1), F.char_length(base) - 1), extra).alias("value"))


@query
def drift_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and types of two runs' records, known or not."""
    root = working_folder(spark, "drift")
    config = runs.RunConfig(root, f"{root}/landing", days_back=400, track_files=True, rescue=True)
    lines = _wide_lines(spark, sf_dir)
    for n in range(2):
        _land_lines(lines.where(F.col("seq") % 2 == n).select("value"), f"{config.landing}/{n}")
        runs.run_increment(spark, config, datetime.fromisoformat(RUN_TS), f"run-{n}")
    return runs.drift_report(spark, config)


@query
def drift_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's known fields and, as JSON, what lies beyond them."""
    rows = drift.with_rescued(_wide_lines(spark, sf_dir))
    return rows.withColumn("rescued", F.to_json(drift.RESCUED)).drop(drift.RESCUED)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw batch to overall statistics."""
    return reports.overall_stats(processed(use_utc(spark), sf_dir))
