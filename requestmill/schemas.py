"""Relations of the service-request model and the fixed values around them."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "unique_key"

# The raw projection, in order. Every raw column arrives as text.
RAW_COLUMNS = (
    "unique_key",
    "created_date",
    "closed_date",
    "agency",
    "complaint_type",
    "descriptor",
    "borough",
    "status",
    "latitude",
    "longitude",
)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# The same after extraction, which reads the two dates.
EXTRACTED_SCHEMA = T.StructType(
    [
        T.StructField(n, T.TimestampType() if n in ("created_date", "closed_date") else T.StringType())
        for n in RAW_COLUMNS
    ]
)

# The processed relation, in order.
PROCESSED_SCHEMA = T.StructType(
    [
        T.StructField("unique_key", T.StringType()),
        T.StructField("created_date", T.TimestampType()),
        T.StructField("closed_date", T.TimestampType()),
        T.StructField("agency", T.StringType()),
        T.StructField("complaint_type", T.StringType()),
        T.StructField("descriptor", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("created_year", T.IntegerType()),
        T.StructField("created_month", T.IntegerType()),
        T.StructField("created_day", T.IntegerType()),
        T.StructField("created_hour", T.IntegerType()),
        T.StructField("created_weekday", T.StringType()),
        T.StructField("resolution_hours", T.DoubleType()),
        T.StructField("is_closed", T.BooleanType()),
        T.StructField("has_location", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("data_quality_score", T.IntegerType()),
    ]
)
PROCESSED_COLUMNS = tuple(PROCESSED_SCHEMA.names)

# The reporting table holds the score as a float.
REPORTING_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.DoubleType()) if f.name == "data_quality_score" else f
        for f in PROCESSED_SCHEMA
    ]
)

# Length limits and mandatory columns of the reporting table.
TEXT_LIMITS = {
    "unique_key": 50,
    "agency": 50,
    "complaint_type": 100,
    "descriptor": 200,
    "borough": 50,
    "status": 50,
    "created_weekday": 20,
}
REQUIRED_COLUMNS = ("unique_key", "created_date")

# Columns parsed as timestamps when they are present.
TIMESTAMP_COLUMNS = (
    "created_date",
    "closed_date",
    "resolution_action_updated_date",
    "due_date",
    "resolution_due_date",
)

# Columns whose text is trimmed and upper-cased.
TEXT_COLUMNS = ("agency", "complaint_type", "descriptor", "borough", "status")

# Borough names as first published, and their standard form.
BOROUGH_NAMES = {
    "Queens": "QUEENS",
    "Brooklyn": "BROOKLYN",
    "Manhattan": "MANHATTAN",
    "Bronx": "BRONX",
    "Staten Island": "STATEN ISLAND",
    "Unspecified": "UNSPECIFIED",
}

# Categorical columns filled with UNKNOWN when they are present.
CATEGORICAL_COLUMNS = (
    "agency", "complaint_type", "descriptor", "borough", "status",
    "incident_address", "street_name", "cross_street_1", "cross_street_2",
    "intersection_street_1", "intersection_street_2", "address_type",
    "city", "landmark", "facility_type", "park_facility_name",
    "park_borough", "vehicle_type", "taxi_company_borough",
    "bridge_highway_name", "road_ramp", "bridge_highway_segment",
    "bridge_highway_direction", "created_weekday", "created_month_name",
)

# Numeric columns filled with 0 when they are present.
NUMERIC_COLUMNS = (
    "incident_zip", "x_coordinate", "y_coordinate",
    "latitude", "longitude", "created_year", "created_month",
    "created_day", "created_hour", "resolution_hours", "data_quality_score",
)

# Flags filled with false when they are present.
FLAG_COLUMNS = ("is_closed", "has_location")

# Accepted coordinate range, both ends included.
LATITUDE_RANGE = (40.4, 41.0)
LONGITUDE_RANGE = (-74.5, -73.7)

# Texts a CSV reader of the pandas kind takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Texts that stand for a missing timestamp before Parquet.
NULL_TIMESTAMP_TOKENS = ("", "NaT", "None")

# Points per present field.
SCORE_WEIGHTS = {
    "unique_key": 25,
    "created_date": 20,
    "has_location": 20,
    "complaint_type": 15,
    "agency": 10,
    "borough": 10,
}

UNKNOWN = "UNKNOWN"

# The alternative incident table, without its database-assigned id.
INCIDENT_LIMITS = {
    "unique_key": 50,
    "agency": 100,
    "complaint_type": 255,
    "descriptor": 255,
    "location_type": 100,
    "incident_zip": 10,
    "borough": 50,
}
INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("unique_key", T.StringType()),
        T.StructField("created_date", T.TimestampType()),
        T.StructField("agency", T.StringType()),
        T.StructField("complaint_type", T.StringType()),
        T.StructField("descriptor", T.StringType()),
        T.StructField("location_type", T.StringType()),
        T.StructField("incident_zip", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("last_processed_time", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("raw_count", T.LongType()),
        T.StructField("processed_count", T.LongType()),
        T.StructField("avg_quality_score", T.DoubleType()),
        T.StructField("records_with_location", T.LongType()),
        T.StructField("raw_path", T.StringType()),
        T.StructField("processed_path", T.StringType()),
        T.StructField("publish_status", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rejected_count", T.LongType()),
        T.StructField("raw_status", T.StringType()),
        T.StructField("processed_status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("pending_count", T.LongType()),
        T.StructField("skipped_count", T.LongType()),
    ]
)

PROCESSED_FILES_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_time", T.TimestampType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)
