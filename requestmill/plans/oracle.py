"""The same queries in DuckDB's SQL, written from the rules and not from the plans."""

from __future__ import annotations

from requestmill import schemas as S
from requestmill.functions.text import WHITESPACE
from requestmill.plans.queries import LEDGER_BATCH, ROLLED, RUN_TS, TIGHT_LIMITS

_FMT = "'%Y-%m-%dT%H:%M:%S.%g'"
_SECONDS = "'%Y-%m-%d %H:%M:%S'"
_ISO_SECONDS = "'%Y-%m-%dT%H:%M:%S'"

RAW = f"""raw_requests AS (
  SELECT
    CAST(CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS unique_key,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-date' ELSE strftime(ts, {_FMT}) END AS created_date,
    CASE WHEN event_type IN ('click', 'view') THEN NULL
         WHEN event_type = 'error' THEN strftime(ts - to_minutes(CAST(floor(value) AS BIGINT)), {_FMT})
         ELSE strftime(ts + to_minutes(CAST(floor(value) AS BIGINT)), {_FMT}) END AS closed_date,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ' nan '
         ELSE concat('  ', event_type, ' ') END AS agency,
    CASE WHEN event_id % 17 = 0 THEN NULL
         ELSE concat('type ', json_extract_string(props, '$.k')) END AS complaint_type,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('user ', user_id) END AS descriptor,
    CASE WHEN event_id % 19 = 0 THEN NULL
         WHEN user_id % 6 = 0 THEN 'Queens' WHEN user_id % 6 = 1 THEN 'brooklyn '
         WHEN user_id % 6 = 2 THEN 'MANHATTAN' WHEN user_id % 6 = 3 THEN 'Bronx'
         WHEN user_id % 6 = 4 THEN 'Staten Island' ELSE 'Unspecified' END AS borough,
    CASE WHEN event_type IN ('click', 'view') THEN 'Open' ELSE 'Closed' END AS status,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 'abc'
         ELSE CAST((4030 + event_id % 90) / 100 AS VARCHAR) END AS latitude,
    CASE WHEN event_id % 31 = 0 THEN NULL
         ELSE CAST(-(7360 + event_id % 100) / 100 AS VARCHAR) END AS longitude,
    event_id AS seq
  FROM events)"""

INCREMENTS = """batch_a AS (
  SELECT *, 1 AS batch_id FROM raw_requests WHERE seq % 10 < 7),
batch_b AS (
  SELECT * REPLACE ('Closed' AS status), 2 AS batch_id FROM raw_requests WHERE seq % 10 >= 5)"""

_OUTSIDE = (
    "lat IS NOT NULL AND lon IS NOT NULL AND NOT "
    "(lat >= 40.4 AND lat <= 41.0 AND lon >= -74.5 AND lon <= -73.7)"
)


def _clean(column: str) -> str:
    return f"nullif(upper(regexp_replace({column}, '^\\s+|\\s+$', '', 'g')), 'NAN')"


def stages(source: str, tag: str = "", carry: str = "", distinct: bool = True) -> str:
    """CTEs from a raw relation to ``processed{tag}``, one per stage."""
    keep = (
        "QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY seq) = 1" if distinct else ""
    )
    return f"""typed{tag} AS (
  SELECT * REPLACE (try_cast(created_date AS TIMESTAMP) AS created_date,
                    try_cast(closed_date AS TIMESTAMP) AS closed_date),
         try_cast(latitude AS DOUBLE) AS lat, try_cast(longitude AS DOUBLE) AS lon
  FROM {source} {keep}),
cleaned{tag} AS (
  SELECT unique_key, created_date, closed_date,
    {', '.join(f'{_clean(c)} AS {c}' for c in S.TEXT_COLUMNS)},
    CASE WHEN {_OUTSIDE} THEN NULL ELSE lat END AS latitude,
    CASE WHEN {_OUTSIDE} THEN NULL ELSE lon END AS longitude,
    CAST(epoch_us(closed_date) - epoch_us(created_date) AS DOUBLE) / 1e6 / 3600 AS hours,
    seq{carry}
  FROM typed{tag}),
flagged{tag} AS (
  SELECT * EXCLUDE (hours),
    CAST(year(created_date) AS INTEGER) AS created_year,
    CAST(month(created_date) AS INTEGER) AS created_month,
    CAST(day(created_date) AS INTEGER) AS created_day,
    CAST(hour(created_date) AS INTEGER) AS created_hour,
    dayname(created_date) AS created_weekday,
    CASE WHEN hours >= 0 THEN hours END AS resolution_hours,
    closed_date IS NOT NULL AS is_closed,
    latitude IS NOT NULL AND longitude IS NOT NULL AS has_location
  FROM cleaned{tag}),
filled{tag} AS (
  SELECT * REPLACE (
    coalesce(agency, 'UNKNOWN') AS agency,
    coalesce(complaint_type, 'UNKNOWN') AS complaint_type,
    coalesce(descriptor, 'UNKNOWN') AS descriptor,
    coalesce(borough, 'UNKNOWN') AS borough,
    coalesce(status, 'UNKNOWN') AS status,
    coalesce(created_weekday, 'UNKNOWN') AS created_weekday,
    coalesce(latitude, 0) AS latitude,
    coalesce(longitude, 0) AS longitude,
    coalesce(created_year, 0) AS created_year,
    coalesce(created_month, 0) AS created_month,
    coalesce(created_day, 0) AS created_day,
    coalesce(created_hour, 0) AS created_hour,
    coalesce(resolution_hours, 0) AS resolution_hours)
  FROM flagged{tag}),
scored{tag} AS (
  SELECT *, TIMESTAMP '{RUN_TS}' AS processed_at, CAST(
      CASE WHEN unique_key IS NOT NULL THEN 25 ELSE 0 END
    + CASE WHEN created_date IS NOT NULL THEN 20 ELSE 0 END
    + CASE WHEN has_location THEN 20 ELSE 0 END
    + CASE WHEN complaint_type <> 'UNKNOWN' THEN 15 ELSE 0 END
    + CASE WHEN agency <> 'UNKNOWN' THEN 10 ELSE 0 END
    + CASE WHEN borough <> 'UNKNOWN' THEN 10 ELSE 0 END AS INTEGER) AS data_quality_score
  FROM filled{tag}),
processed{tag} AS (
  SELECT {', '.join(S.PROCESSED_COLUMNS)}{carry} FROM scored{tag})"""


PROCESSED = f"WITH {RAW}, {stages('raw_requests')}"
# Every raw row taken through the steps, duplicates included.
EVERY_ROW = f"WITH {RAW}, {stages('raw_requests', distinct=False)}"
WITH_RAW = f"WITH {RAW}"
BATCHES = f"WITH {RAW}, {INCREMENTS}"
PROCESSED_BATCHES = (
    f"{BATCHES}, {stages('batch_a', '_a', ', batch_id')}, {stages('batch_b', '_b', ', batch_id')}"
)
_LAST = "QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY batch_id DESC, seq DESC) = 1"
_NEWEST_BATCH = "QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY batch_id DESC) = 1"
_RAW_COLUMNS = ", ".join(S.RAW_COLUMNS)
_DATED = """SELECT seq, try_cast(created_date AS TIMESTAMP) AS created_date,
  try_cast(closed_date AS TIMESTAMP) AS closed_date FROM raw_requests"""
_MERGED = f"""SELECT * EXCLUDE (batch_id) FROM
  (SELECT * FROM processed_a UNION ALL SELECT * FROM processed_b) {_NEWEST_BATCH}"""
_MS = "date_trunc('millisecond', processed_at) AS processed_at"
_MERGED_MS = f"""SELECT * EXCLUDE (batch_id) REPLACE ({_MS}) FROM
  (SELECT * FROM processed_a UNION ALL SELECT * FROM processed_b) {_NEWEST_BATCH}"""

_FLAWED = f"""WITH {RAW}, f AS (
  SELECT seq, try_cast(created_date AS TIMESTAMP) AS created,
    CASE WHEN seq % 89 = 0 THEN 'malformed' WHEN seq % 101 = 0 THEN 'future'
         WHEN seq % 97 = 0 THEN 'undated' ELSE 'ok' END AS kind FROM raw_requests)"""

LEDGER = f"""ledger AS (
  SELECT 'run-' || lpad(CAST(seq // {LEDGER_BATCH} AS VARCHAR), 12, '0') AS run_id,
    count(*) AS raw_count,
    count(try_cast(created_date AS TIMESTAMP)) AS processed_count,
    max(try_cast(created_date AS TIMESTAMP)) AS committed_at
  FROM raw_requests GROUP BY seq // {LEDGER_BATCH})"""


def _number(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def _rule_rows(relation: str, limits: dict[str, int]) -> str:
    """Violations per rule, one SELECT each."""
    rules = {
        "unique_key_duplicate": "count(unique_key) - count(DISTINCT unique_key)",
        **{f"{c}_missing": f"count(*) - count({c})" for c in S.REQUIRED_COLUMNS},
        **{f"{c}_too_long": f"count(*) FILTER (WHERE length({c}) > {n})" for c, n in limits.items()},
    }
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {_number(count)} AS violations FROM {relation}"
        for rule, count in rules.items()
    )


def _profile_rows() -> str:
    kinds = {f.name: f.dataType.simpleString() for f in S.PROCESSED_SCHEMA}
    rows = []
    for place, column in enumerate(S.PROCESSED_COLUMNS, start=1):
        shown = (
            f"strftime({column}, {_SECONDS})"
            if kinds[column] == "timestamp"
            else f"CAST({column} AS VARCHAR)"
        )
        rows.append(
            f"SELECT CAST({place} AS INTEGER) AS position, '{column}' AS column_name, "
            f"'{kinds[column]}' AS data_type, count({column}) AS non_null, count(*) AS total, "
            f"(SELECT {shown} FROM scored ORDER BY seq LIMIT 1) AS first_value FROM scored"
        )
    return " UNION ALL ".join(rows)


def _null_rows() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM processed"
        for c in S.PROCESSED_COLUMNS
    )
    return f"SELECT * FROM ({counts}) WHERE null_count > 0"


def _schema_rows(missing: str | None = None, extra: str | None = None) -> str:
    """The expected layout against the processed one, less and plus a column."""
    kinds = {f.name: f.dataType.simpleString() for f in S.PROCESSED_SCHEMA}
    actual = [c for c in S.PROCESSED_COLUMNS if c != missing] + ([extra] if extra else [])
    rows = []
    for column in list(S.PROCESSED_COLUMNS) + ([extra] if extra else []):
        wanted = S.PROCESSED_COLUMNS.index(column) + 1 if column in kinds else None
        place = actual.index(column) + 1 if column in actual else None
        if place is None:
            status = "missing"
        elif wanted is None:
            status = "extra"
        else:
            status = "ok" if place == wanted else "misplaced"
        kind = kinds.get(column, "bigint")
        longest = f"max(length({column}))" if place and kind == "string" else "max(NULL)"
        nulls = f"count(*) - count({column})" if place else "max(NULL)"
        rows.append(
            f"SELECT '{column}' AS column_name, CAST({wanted or 'NULL'} AS INTEGER) AS "
            f"expected_position, CAST({place or 'NULL'} AS INTEGER) AS actual_position, "
            f"'{kind}' AS data_type, CAST({S.TEXT_LIMITS.get(column, 'NULL')} AS INTEGER) AS "
            f"max_length, {'false' if column in S.REQUIRED_COLUMNS else 'true'} AS nullable, "
            f"'{status}' AS status, CAST({longest} AS INTEGER) AS longest, "
            f"CAST({nulls} AS BIGINT) AS nulls FROM scored"
        )
    return " UNION ALL ".join(rows)


_TOKENS = ", ".join(f"'{t}'" for t in S.NA_TOKENS)


_MOVED = f"""{PROCESSED_BATCHES}, batch_c AS (SELECT * REPLACE (
    strftime(try_cast(created_date AS TIMESTAMP) + INTERVAL 3 DAY, {_FMT}) AS created_date, 3 AS batch_id)
  FROM batch_a WHERE seq % 4 = 0 AND try_cast(created_date AS TIMESTAMP) IS NOT NULL),
{stages('batch_c', '_c', ', batch_id')}, processed AS (SELECT * EXCLUDE (batch_id) FROM (
  SELECT * FROM processed_a UNION ALL SELECT * FROM processed_b UNION ALL SELECT * FROM processed_c)
  {_NEWEST_BATCH})"""


def _drift() -> dict[str, str]:
    """What the records hold: the ten text columns where they are not NULL, and three further fields."""
    wide = f"""{WITH_RAW}, w AS (SELECT *,
      CASE WHEN seq % 5 = 0 THEN concat('c', seq % 3) END AS channel,
      CASE WHEN seq % 7 = 0 AND seq % 2 = 0 THEN 'high' END AS priority_text,
      CASE WHEN seq % 7 = 0 AND seq % 2 = 1 THEN CAST(seq % 10 AS VARCHAR) END AS priority_number,
      CASE WHEN seq % 11 = 0 THEN concat('{{"cell":[', seq % 4, ',', seq % 6, ']}}') END AS geo
      FROM raw_requests)"""
    held = [(c, c, "STRING", "true") for c in S.RAW_COLUMNS]
    held += [("channel", "channel", "STRING", "false"), ("priority_text", "priority", "STRING", "false")]
    held += [("priority_number", "priority", "DECIMAL", "false"), ("geo", "geo", "OBJECT", "false")]
    rows = " UNION ALL ".join(
        f"SELECT '{field}' AS field, '{kind}' AS type, {known} AS is_known, count({c}) AS n_records, "
        f"min({c}) AS least, max({c}) AS most, round(count({c}) / count(*), 6) AS share FROM w "
        for c, field, kind, known in held
    )
    parts = {
        "channel": "concat('\"channel\":\"', channel, '\"')",
        "geo": "concat('\"geo\":', geo)",
        "priority_text": "'\"priority\":\"high\"'",
        "priority_number": "concat('\"priority\":', priority_number)",
    }
    listed = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN {text} END" for c, text in parts.items())
    none = " AND ".join(f"{c} IS NULL" for c in parts)
    return {
        "drift_fields": f"{wide} SELECT * FROM ({rows}) WHERE n_records > 0",
        "drift_rescued": f"""{wide} SELECT seq, {', '.join(S.RAW_COLUMNS)},
          CASE WHEN NOT ({none}) THEN concat('{{', concat_ws(',', {listed}), '}}') END AS rescued FROM w""",
    }


def all_oracles() -> dict[str, str]:
    found = _oracles()
    rolled = {f"rolled_{n}": found[n].replace(PROCESSED, _MOVED, 1) for n in ROLLED}
    return found | rolled | _drift()


def _oracles() -> dict[str, str]:
    score = "round(avg(data_quality_score), 6)"
    positive = "CASE WHEN resolution_hours > 0 THEN resolution_hours END"
    return {
        "incremental_scan": f"""{WITH_RAW} SELECT * FROM (
            SELECT unique_key, try_cast(created_date AS TIMESTAMP) AS created_date,
              try_cast(closed_date AS TIMESTAMP) AS closed_date, agency, seq FROM raw_requests)
            WHERE created_date >= TIMESTAMP '2024-01-15 12:00:00'""",
        "incremental_order": f"""{WITH_RAW} SELECT * FROM (
            SELECT unique_key, try_cast(created_date AS TIMESTAMP) AS created_date, seq
            FROM raw_requests)
            WHERE created_date >= TIMESTAMP '2024-01-15 12:00:00' ORDER BY created_date, seq""",
        "since_normalise": f"""{WITH_RAW} SELECT seq,
            regexp_replace(created_date, '\\..*$', '') AS since_text,
            regexp_replace(created_date, '\\..*$', '') AS since_from_spaced FROM raw_requests""",
        "full_backfill": f"""{WITH_RAW} SELECT * FROM (
            SELECT unique_key, try_cast(created_date AS TIMESTAMP) AS created_date, seq
            FROM raw_requests) WHERE created_date >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""",
        "json_landing": f"{WITH_RAW} SELECT * FROM raw_requests",
        "json_payload": f"{WITH_RAW} SELECT * FROM raw_requests",
        "csv_roundtrip": f"{WITH_RAW} SELECT {_RAW_COLUMNS} FROM raw_requests",
        "parquet_ms_roundtrip": f"{PROCESSED} SELECT * REPLACE ({_MS}) FROM processed",
        "full_refresh_table": f"""{PROCESSED} SELECT * REPLACE (
            CAST(data_quality_score AS DOUBLE) AS data_quality_score)
            FROM processed WHERE created_date IS NOT NULL""",
        "epoch_ns_to_ts": f"""SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN ts
            ELSE date_trunc('millisecond', ts) END AS created_date FROM events""",
        "state_roundtrip": f"""{PROCESSED} SELECT
            strftime(max(created_date), {_ISO_SECONDS}) AS last_processed_time,
            '{RUN_TS.replace(' ', 'T')}' AS updated_at FROM processed""",
        "incident_table": f"""{EVERY_ROW} SELECT unique_key, created_date, agency, complaint_type,
            descriptor, CAST(NULL AS VARCHAR) AS location_type,
            CAST(NULL AS VARCHAR) AS incident_zip, borough, lat AS latitude, lon AS longitude,
            TIMESTAMP '{RUN_TS}' AS created_at FROM typed""",
        "select_available": f"""{WITH_RAW} SELECT * REPLACE (CAST(NULL AS VARCHAR) AS descriptor,
            CAST(NULL AS VARCHAR) AS status) FROM raw_requests""",
        "parse_timestamps": """SELECT seq, moment AS created_date, moment AS due_date FROM (
            SELECT event_id AS seq, CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 9 IN (0, 2) THEN date_trunc('millisecond', ts)
              WHEN event_id % 9 IN (1, 4, 5) THEN date_trunc('second', ts)
              ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS moment FROM events)""",
        "parse_numbers": f"""{WITH_RAW} SELECT seq,
            CASE WHEN seq % 5 < 3 THEN try_cast(latitude AS DOUBLE) END AS latitude,
            try_cast(longitude AS DOUBLE) AS longitude FROM raw_requests""",
        "bounding_box": f"{EVERY_ROW} SELECT seq, latitude, longitude FROM cleaned",
        "normalise_text": f"{EVERY_ROW} SELECT seq, {', '.join(S.TEXT_COLUMNS)} FROM cleaned",
        "category_lookup": f"""{WITH_RAW} SELECT seq, CASE borough
            WHEN 'Queens' THEN 'QUEENS' WHEN 'Bronx' THEN 'BRONX'
            WHEN 'Staten Island' THEN 'STATEN ISLAND' WHEN 'Unspecified' THEN 'UNSPECIFIED'
            ELSE borough END AS borough FROM raw_requests""",
        "collated_value_counts": f"""{WITH_RAW}, t AS (SELECT
              CASE WHEN seq % 3 = 0 THEN lower(borough) ELSE borough END
              || CASE WHEN seq % 4 = 0 THEN '  ' ELSE '' END AS text FROM raw_requests),
            s AS (SELECT text, count(*) AS n FROM t GROUP BY text),
            r AS (SELECT *, lower(rtrim(text)) AS k,
              row_number() OVER (PARTITION BY lower(rtrim(text)) ORDER BY n DESC, text) AS place FROM s)
            SELECT max(text) FILTER (WHERE place = 1) AS value, CAST(sum(n) AS BIGINT) AS n_rows,
              count(*) AS n_spellings FROM r GROUP BY k""",
        "category_lookup_by_table": f"""{WITH_RAW} SELECT seq, coalesce(c_name, descriptor) AS descriptor, way
            FROM raw_requests LEFT JOIN customer ON descriptor = concat('user ', c_custkey)
            CROSS JOIN (VALUES ('broadcast'), ('shuffle')) AS v(way)""",
        "date_parts": f"""{EVERY_ROW} SELECT seq, created_date, created_year, created_month,
            created_day, created_hour, strftime(created_date, '%A') AS created_weekday
            FROM flagged""",
        "resolution_hours": f"{EVERY_ROW} SELECT seq, resolution_hours FROM flagged",
        "status_flags": f"{EVERY_ROW} SELECT seq, is_closed, has_location FROM flagged",
        "fill_missing": f"{EVERY_ROW} SELECT * FROM filled",
        "quality_score": f"{EVERY_ROW} SELECT seq, data_quality_score FROM scored",
        "drop_empty_rows": f"""{WITH_RAW} SELECT seq, agency, descriptor, borough
            FROM raw_requests WHERE coalesce(agency, descriptor, borough) IS NOT NULL""",
        "format_timestamps": f"""WITH {RAW}, dated AS ({_DATED}) SELECT seq,
            strftime(created_date, {_SECONDS}) AS created_date,
            coalesce(strftime(closed_date, {_SECONDS}), '') AS closed_date,
            '{RUN_TS.split('.')[0]}' AS processed_at FROM dated""",
        "null_tokens": f"""WITH {RAW}, dated AS ({_DATED}) SELECT seq,
            CASE WHEN seq % 5 > 1 THEN date_trunc('second', created_date) END AS created_date,
            date_trunc('second', closed_date) AS closed_date FROM dated""",
        "na_tokens": f"""{WITH_RAW} SELECT seq, CASE
            WHEN seq % 3 = 0 THEN NULL
            WHEN seq % 3 = 1
              THEN ' ' || [{_TOKENS}][CAST(seq % {len(S.NA_TOKENS)} + 1 AS INTEGER)]
            ELSE complaint_type END AS complaint_type FROM raw_requests""",
        "canonical_columns": f"""{WITH_RAW} SELECT * EXCLUDE (seq, descriptor)
            FROM raw_requests""",
        "text_predicates": f"""{WITH_RAW} SELECT seq,
            CASE WHEN seq % 3 = 0 THEN false ELSE borough IS NOT NULL END AS borough_filled,
            status ILIKE 'closed' AS closed,
            left(coalesce(descriptor, ''), 5) || '...' AS descriptor_preview FROM raw_requests""",
        "transform_full": f"{PROCESSED} SELECT * FROM processed",
        "transform_text": f"""{PROCESSED} SELECT * REPLACE (
            strftime(created_date, {_SECONDS}) AS created_date,
            coalesce(strftime(closed_date, {_SECONDS}), '') AS closed_date,
            strftime(processed_at, {_SECONDS}) AS processed_at) FROM processed""",
        "dedup_first": f"""{WITH_RAW} SELECT * FROM raw_requests
            WHERE seq IN (SELECT min(seq) FROM raw_requests GROUP BY unique_key)""",
        "duplicate_counts": f"""{WITH_RAW} SELECT count(*) AS total_rows,
            count(DISTINCT unique_key) AS distinct_keys,
            count(*) - count(DISTINCT unique_key) AS duplicates_removed FROM raw_requests""",
        "merge_keep_last": f"""{BATCHES} SELECT * FROM
            (SELECT * FROM batch_a UNION ALL SELECT * FROM batch_b) {_LAST}""",
        "merge_anti_join": f"""{BATCHES} SELECT * FROM
            (SELECT * FROM batch_a UNION ALL SELECT * FROM batch_b) {_LAST}""",
        "merge_replay": f"""{BATCHES} SELECT * FROM
            (SELECT * FROM batch_a UNION ALL SELECT * FROM batch_b) {_LAST}""",
        "union_by_name": f"""{BATCHES} SELECT * REPLACE (CAST(NULL AS VARCHAR) AS descriptor)
            FROM batch_a UNION ALL SELECT * FROM batch_b""",
        "append_without_key": f"""{BATCHES} SELECT * EXCLUDE (unique_key) FROM batch_a
            UNION ALL SELECT * EXCLUDE (unique_key) FROM batch_b""",
        "merge_processed": f"{PROCESSED_BATCHES} {_MERGED}",
        "merge_without_order": f"""{BATCHES}, ranked AS (
            SELECT unique_key, created_date, status, seq, batch_id
            FROM (SELECT * FROM batch_a UNION ALL SELECT * FROM batch_b)
            QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY batch_id DESC,
              created_date DESC NULLS LAST, status DESC NULLS LAST, seq DESC) = 1)
            SELECT unique_key, created_date, status, seq, way FROM ranked
            CROSS JOIN (VALUES ('union'), ('join')) AS w(way)""",
        "merge_master_days": f"{PROCESSED_BATCHES} {_MERGED_MS}",
        "merge_master_buckets": f"{PROCESSED_BATCHES} {_MERGED_MS}",
        "total_rows": f"{PROCESSED} SELECT count(*) AS total_rows FROM processed",
        "overall_stats": f"""{PROCESSED} SELECT count(*) AS total_rows,
            count(DISTINCT unique_key) AS unique_records,
            count(closed_date) AS rows_with_closed_date,
            count(CASE WHEN resolution_hours > 0 THEN 1 END) AS rows_with_resolution_hours,
            round(avg({positive}), 2) AS avg_resolution_hours,
            max(created_date) AS latest_record, max(processed_at) AS last_processed
            FROM processed""",
        "completeness_report": _completeness(),
        "quality_bands": f"""{PROCESSED} SELECT {score} AS avg_quality,
            min(data_quality_score) AS min_quality, max(data_quality_score) AS max_quality,
            count(CASE WHEN data_quality_score >= 80 THEN 1 END) AS high_quality_count,
            count(CASE WHEN data_quality_score BETWEEN 50 AND 79 THEN 1 END)
              AS medium_quality_count,
            count(CASE WHEN data_quality_score < 50 THEN 1 END) AS low_quality_count
            FROM processed""",
        "top_agencies": f"""{PROCESSED} SELECT agency, count(*) AS request_count FROM processed
            GROUP BY agency ORDER BY request_count DESC, agency LIMIT 5""",
        "date_range": f"""{PROCESSED} SELECT min(created_date) AS earliest,
            max(created_date) AS latest FROM processed""",
        "data_summary": f"""{PROCESSED} SELECT count(*) AS total_records,
            count(DISTINCT agency) AS agencies,
            count(DISTINCT complaint_type) AS complaint_types,
            min(created_date) AS earliest_date, max(created_date) AS latest_date
            FROM processed""",
        "quality_summary": f"""{PROCESSED} SELECT count(*) AS total_records,
            {score} AS avg_quality, min(created_date) AS earliest_record,
            max(created_date) AS latest_record FROM processed""",
        "closed_summary": f"""{PROCESSED} SELECT count(*) AS total_records,
            {score} AS avg_quality_score,
            count(CASE WHEN status ILIKE 'Closed' THEN 1 END) AS closed_count FROM processed""",
        "column_stats": f"""{PROCESSED} SELECT count(closed_date) AS closed_date_count,
            count(resolution_hours) AS resolution_hours_count, {score} AS avg_quality
            FROM processed""",
        "run_check": f"""{PROCESSED} SELECT count(*) AS total_rows,
            count(closed_date) AS rows_with_closed_date,
            count(resolution_hours) AS rows_with_resolution_hours,
            round(avg({positive}), 6) AS avg_resolution_hours,
            max(created_date) AS latest_record, max(processed_at) AS last_processed
            FROM processed""",
        "avg_quality": f"{PROCESSED} SELECT {score} AS avg_quality FROM processed",
        "null_census": f"{PROCESSED} {_null_rows()}",
        "high_water_mark": f"""{PROCESSED} SELECT
            strftime(max(created_date), {_ISO_SECONDS}) AS last_processed_time FROM processed""",
        "latest_created": f"""{PROCESSED} SELECT * FROM processed
            ORDER BY created_date DESC NULLS LAST, unique_key LIMIT 10""",
        "latest_processed_report": f"""{PROCESSED} SELECT unique_key, created_date, closed_date,
            agency, complaint_type, resolution_hours, is_closed, data_quality_score, processed_at,
            coalesce(strftime(closed_date, {_SECONDS}), 'Still Open') AS closed_display,
            left(complaint_type, 50) || '...' AS complaint_preview
            FROM processed ORDER BY processed_at DESC, unique_key LIMIT 5""",
        "column_profile": f"{PROCESSED} {_profile_rows()}",
        "transform_summary": f"""{PROCESSED} SELECT original AS original_records,
            count(*) AS transformed_records, original - count(*) AS records_removed,
            CAST({len(S.PROCESSED_COLUMNS) - len(S.RAW_COLUMNS)} AS INTEGER) AS columns_added,
            {score} AS avg_quality_score,
            count(*) FILTER (WHERE has_location) AS records_with_location,
            count(*) FILTER (WHERE is_closed) AS closed_complaints
            FROM processed, (SELECT count(*) AS original FROM raw_requests) GROUP BY original""",
        "batch_metrics": f"""{PROCESSED} SELECT
            (SELECT count(*) FROM raw_requests) AS raw_count, count(*) AS processed_count,
            {score} AS avg_quality_score,
            count(*) FILTER (WHERE has_location) AS records_with_location FROM processed""",
        "cleaning_counts": f"""{PROCESSED} SELECT
            count(*) FILTER (WHERE {_OUTSIDE}) AS invalid_coordinates,
            count(*) FILTER (WHERE closed_date < created_date) AS negative_durations
            FROM typed""",
        "batch_ledger": f"""WITH {RAW}, {LEDGER} SELECT count(*) AS total_batches,
            arg_min(run_id, committed_at) AS first_batch,
            arg_max(run_id, committed_at) AS last_batch,
            CAST(sum(raw_count) AS BIGINT) AS raw_records FROM ledger""",
        "recent_batches": f"""WITH {RAW}, {LEDGER} SELECT run_id, raw_count, processed_count,
            'success' AS status FROM ledger ORDER BY committed_at DESC, run_id DESC LIMIT 5""",
        "state_report": f"""{PROCESSED}, {LEDGER} SELECT
            strftime(max(committed_at), {_ISO_SECONDS}) AS last_successful_run,
            (SELECT strftime(max(created_date), {_ISO_SECONDS}) FROM processed)
              AS last_processed_date,
            CAST(sum(processed_count) AS BIGINT) AS total_records_processed FROM ledger""",
        "contract_violations": f"""{PROCESSED_BATCHES},
            together AS (SELECT * FROM processed_a UNION ALL SELECT * FROM processed_b)
            {_rule_rows('together', S.TEXT_LIMITS)}""",
        "length_violations": f"{PROCESSED} {_rule_rows('processed', TIGHT_LIMITS)}",
        "quarantine": f"""{PROCESSED} SELECT unique_key, created_date, concat_ws(',',
              CASE WHEN unique_key IS NULL THEN 'unique_key_missing' END,
              CASE WHEN created_date IS NULL THEN 'created_date_missing' END,
              {', '.join(f"CASE WHEN length({c}) > {n} THEN '{c}_too_long' END"
                         for c, n in TIGHT_LIMITS.items())}) AS violations
            FROM processed WHERE unique_key IS NULL OR created_date IS NULL OR
              {' OR '.join(f'length({c}) > {n}' for c, n in TIGHT_LIMITS.items())}""",
        "schema_contract": f"{PROCESSED} {_schema_rows()}",
        "schema_drift": f"{PROCESSED} {_schema_rows('status', 'seq')}",
        **_other_tables(),
        "run_record": f"""{PROCESSED} SELECT 'load-1' AS run_id,
            TIMESTAMP '{RUN_TS}' AS committed_at,
            (SELECT count(*) FROM raw_requests) AS raw_count, count(*) AS processed_count,
            {score} AS avg_quality_score,
            count(*) FILTER (WHERE has_location) AS records_with_location,
            'succeeded' AS publish_status, 'success' AS status,
            CAST(0 AS BIGINT) AS rejected_count, 'succeeded' AS raw_status,
            'succeeded' AS processed_status, CAST(NULL AS VARCHAR) AS error,
            CAST(0 AS BIGINT) AS pending_count, CAST(0 AS BIGINT) AS skipped_count FROM processed""",
        "run_record_failed": f"""{PROCESSED}, n AS (SELECT
              (SELECT count(*) FROM raw_requests) AS r, (SELECT count(*) FROM processed) AS p)
            SELECT run_id, r AS raw_count, CASE WHEN merged THEN p END AS processed_count,
              'succeeded' AS raw_status,
              CASE WHEN merged THEN 'succeeded' ELSE 'failed' END AS processed_status,
              publish_status, status, error_kind
            FROM n CROSS JOIN (VALUES
              ('1-merge', false, NULL, 'failed', 'ValueError'),
              ('2-publish', true, 'failed', 'partial', 'OSError'),
              ('3-good', true, 'skipped', 'success', NULL))
              AS v(run_id, merged, publish_status, status, error_kind)""",
        "rejected_rows": f"""{WITH_RAW} SELECT reason, count(*) AS n_rows FROM (
            SELECT CASE WHEN seq % 89 = 0 THEN 'malformed'
              WHEN seq % 101 = 0 THEN 'created in the future'
              WHEN seq % 97 = 0 THEN 'no creation time' END AS reason FROM raw_requests)
            WHERE reason IS NOT NULL GROUP BY reason""",
        "three_runs_of_a_zone": f"""{_FLAWED}, n AS (SELECT
              count(*) FILTER (WHERE kind = 'ok') AS ok, count(*) FILTER (WHERE kind = 'future') AS future,
              count(*) FILTER (WHERE kind <> 'ok') AS bad,
              count(*) FILTER (WHERE kind = 'ok' AND created >= (
                SELECT date_trunc('second', max(created)) FROM f WHERE kind = 'ok')) AS newest FROM f)
            SELECT run_id, raw_count, rejected_count, CAST(0 AS BIGINT) AS pending_count,
              CAST(0 AS BIGINT) AS skipped_count
            FROM (SELECT 'run-1' AS run_id, ok AS raw_count, bad AS rejected_count FROM n
              UNION ALL SELECT 'run-2', newest, 0 FROM n UNION ALL SELECT 'run-3', newest + future, 0 FROM n)""",
        "three_runs_of_new_files": f"""{_FLAWED},
            p AS (SELECT *, seq % 3 + 1 AS landing, seq % 3 = 0 AND kind = 'ok'
                    AND created < TIMESTAMP '{RUN_TS}' - INTERVAL 360 DAY AS early FROM f),
            r AS (SELECT unnest([1, 2, 3]) AS n)
            SELECT 'run-' || n AS run_id,
              count(*) FILTER (WHERE landing = n AND kind = 'ok' AND NOT early
                OR n = 3 AND kind = 'future') AS raw_count,
              count(*) FILTER (WHERE landing = n AND kind IN ('malformed', 'undated')) AS rejected_count,
              count(*) FILTER (WHERE n < 3 AND landing <= n AND kind = 'future') AS pending_count,
              count(*) FILTER (WHERE landing = n AND early) AS skipped_count
            FROM p CROSS JOIN r GROUP BY n""",
        "runs_over_arrival_folders": f"""{WITH_RAW}, p AS (SELECT * FROM (VALUES
              ('run-1', '2025-01-01', 0), ('run-2', '2025-01-05', 1), ('run-3', '2025-01-04', 3),
              ('run-3', '2025-01-06', 4), ('run-4', '2025-01-01', 2)) AS v(run_id, folder_day, share)),
            n AS (SELECT run_id, count(*) FILTER (WHERE seq % 97 <> 0) AS raw_count
              FROM raw_requests JOIN p ON seq % 5 = share GROUP BY run_id)
            SELECT run_id, folder_day, CAST(1 AS BIGINT) AS n_files, raw_count FROM p JOIN n USING (run_id)""",
        "processed_files": """SELECT CAST(3 AS BIGINT) AS n_files, CAST(3 AS BIGINT) AS n_runs,
            '2025-01-01' AS first_day, '2025-01-03' AS last_day, CAST(3 AS BIGINT) AS n_listed
            FROM events HAVING count(*) > 0""",
        "increment_by_files": _by_files(_MS),
        "publish_increment": _by_files(
            f"{_MS}, CAST(data_quality_score AS DOUBLE) AS data_quality_score"
        ),
        "increment_run": _two_runs(),
        "stream_transform": f"{PROCESSED_BATCHES} {_MERGED_MS}",
        **{n: f"""{BATCHES} SELECT * EXCLUDE (batch_id) REPLACE (
              try_cast(created_date AS TIMESTAMP) AS created_date,
              try_cast(closed_date AS TIMESTAMP) AS closed_date)
            FROM (SELECT * FROM batch_a UNION ALL SELECT * FROM batch_b)
            QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY batch_id, seq) = 1"""
            for n in ("stream_dedup", "stream_dedup_by_state", "stream_dedup_past_state")},
        "stream_late_rows": f"""{WITH_RAW}, halves AS (SELECT *, CASE WHEN coalesce(
              created_date < '2024-01-15T12:00:00', false) THEN 2 ELSE 1 END AS batch_id
              FROM raw_requests),
            batch_a AS (SELECT * FROM halves WHERE batch_id = 1),
            batch_b AS (SELECT * FROM halves WHERE batch_id = 2),
            {stages('batch_a', '_a', ', batch_id')}, {stages('batch_b', '_b', ', batch_id')}
            SELECT unique_key, created_date, agency FROM ({_MERGED_MS})""",
        "stream_replay": f"{PROCESSED} SELECT * REPLACE ({_MS}) FROM processed",
    }


def _other_tables() -> dict[str, str]:
    orders = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return {
        "orders_completeness": f"""SELECT count(*) AS total,
            {', '.join(f'count(*) FILTER (WHERE {c} IS NOT NULL) AS {c}_filled' for c in orders)},
            {', '.join(f'round(count({c}) * 100.0 / count(*), 1)::DOUBLE AS {c}_pct'
                       for c in orders)} FROM orders""",
        "orders_top_customers": """SELECT o_custkey, count(*) AS request_count FROM orders
            GROUP BY o_custkey ORDER BY request_count DESC, o_custkey LIMIT 10""",
        "orders_latest": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
            ORDER BY o_orderdate DESC, o_orderkey LIMIT 25""",
        "lineitem_first_of_order": """SELECT * FROM lineitem QUALIFY row_number() OVER (
              PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""",
        "lineitem_duplicate_counts": """SELECT count(*) AS total_rows,
            count(DISTINCT l_orderkey) AS distinct_keys,
            count(*) - count(DISTINCT l_orderkey) AS duplicates_removed FROM lineitem""",
        "events_last_of_user": """SELECT * FROM events
            WHERE event_id IN (SELECT max(event_id) FROM events GROUP BY user_id)""",
        "documents_length_violations": """
            SELECT 'doc_id_duplicate' AS rule,
              count(doc_id) - count(DISTINCT doc_id) AS violations FROM documents
            UNION ALL SELECT 'doc_id_missing', count(*) - count(doc_id) FROM documents
            UNION ALL SELECT 'lang_missing', count(*) - count(lang) FROM documents
            UNION ALL SELECT 'text_too_long', count(*) FILTER (WHERE length(text) > 2000)
              FROM documents
            UNION ALL SELECT 'source_too_long', count(*) FILTER (WHERE length(source) > 4)
              FROM documents
            UNION ALL SELECT 'lang_too_long', count(*) FILTER (WHERE length(lang) > 2)
              FROM documents""",
        "conversations_text_clean": f"""SELECT conv_id, turn, role,
            CASE WHEN t NOT IN ({_TOKENS}) THEN t END AS text
            FROM (SELECT *, trim(text, '{WHITESPACE}') AS t FROM conversations)""",
        "csv_documents_roundtrip": "SELECT doc_id, text, lang, source FROM documents",
        "json_documents_roundtrip": "SELECT doc_id, text, lang, source FROM documents",
    }


def _completeness() -> str:
    filled = {
        "unique_key": "unique_key IS NOT NULL",
        "created_date": "created_date IS NOT NULL",
        "closed_date": "closed_date IS NOT NULL",
        "agency": "agency IS NOT NULL AND rtrim(agency) <> ''",
        "complaint_type": "complaint_type IS NOT NULL AND rtrim(complaint_type) <> ''",
        "resolution_hours": "resolution_hours IS NOT NULL",
        "is_closed": "is_closed IS NOT NULL",
        "data_quality_score": "data_quality_score IS NOT NULL",
    }
    counts = ", ".join(
        f"CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS {c}_filled"
        for c, test in filled.items()
    )
    shares = ", ".join(
        f"round(CAST({c}_filled AS DOUBLE) / total * 100, 1) AS {c}_pct" for c in filled
    )
    return f"""{PROCESSED}, counts AS (SELECT count(*) AS total, {counts} FROM processed)
        SELECT *, {shares} FROM counts"""


def _by_files(replaced: str) -> str:
    """Three runs over dated rows, of which the latest wins."""
    batches = ", ".join(
        f"""batch_{n} AS (SELECT *, {n} AS batch_id FROM raw_requests
          WHERE seq % 3 = {n} AND try_cast(created_date AS TIMESTAMP) IS NOT NULL),
        {stages(f'batch_{n}', f'_{n}', ', batch_id')}"""
        for n in range(3)
    )
    union = " UNION ALL ".join(f"SELECT * FROM processed_{n}" for n in range(3))
    return f"""{WITH_RAW}, {batches} SELECT * EXCLUDE (batch_id) REPLACE ({replaced})
      FROM ({union}) {_NEWEST_BATCH}"""


def _two_runs() -> str:
    """Rows up to noon of the 15th, then rows from the first run's mark on."""
    dated = f"""{WITH_RAW}, dated AS (
        SELECT *, try_cast(created_date AS TIMESTAMP) AS moment FROM raw_requests),
      batch_a AS (
        SELECT * EXCLUDE (moment), 1 AS batch_id FROM dated
        WHERE moment < TIMESTAMP '2024-01-15 12:00:00'),
      batch_b AS (
        SELECT * EXCLUDE (moment), 2 AS batch_id FROM dated WHERE moment >= (
          SELECT date_trunc('second', max(moment)) FROM dated
          WHERE moment < TIMESTAMP '2024-01-15 12:00:00'))"""
    return f"""{dated}, {stages('batch_a', '_a', ', batch_id')},
      {stages('batch_b', '_b', ', batch_id')} {_MERGED_MS}"""
