"""Hand-derived results of the transform, and each deliberate rule of it."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from requestmill import schemas as S
from requestmill.operators import clean, reports
from requestmill.plans.sample_data import raw_requests
from requestmill.plans.transform import TransformOptions, transform

RUN_TS = datetime(2025, 11, 1, 12, 0, 0)
SMALL = "/root/testdata/sf0.001"

FOUR = [
    ("1", "2025-10-31 10:00", "2025-10-31 15:00", "NYPD", "Noise", "Manhattan", "40.7589", "-73.9851", 0),
    ("2", "2025-10-31 11:00", None, "FDNY", "Fire", "Brooklyn", "40.6892", "-73.9442", 1),
    ("2", "2025-10-31 11:00", None, "FDNY", "Fire", "Brooklyn", "40.6892", "-73.9442", 2),
    ("3", "2025-10-31 12:00", "2025-10-31 14:00", "DOT", "Pothole", "Queens", "40.7282", "-73.7949", 3),
]
FOUR_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "complaint_type", "borough",
    "latitude", "longitude", "seq",
]


def raw_rows(spark, *rows):
    """Raw rows from partial dictionaries; ``seq`` is their place."""
    base = {
        "unique_key": "1",
        "created_date": "2025-01-15 10:30:00",
        "closed_date": None,
        "agency": "NYPD",
        "complaint_type": "Noise",
        "descriptor": "Loud",
        "borough": "BROOKLYN",
        "status": "Open",
        "latitude": "40.6782",
        "longitude": "-73.9442",
    }
    fields = [f"{c} string" for c in S.RAW_COLUMNS] + ["seq bigint"]
    data = [tuple({**base, **row}.values()) + (i,) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(fields))


def one(spark, options=TransformOptions(), **values):
    return transform(raw_rows(spark, values), RUN_TS, options).first()


def test_four_row_sample(spark):
    raw = spark.createDataFrame(FOUR, ", ".join(
        f"{c} {'bigint' if c == 'seq' else 'string'}" for c in FOUR_COLUMNS))
    result = transform(raw, RUN_TS)
    assert result.columns == [
        c for c in S.PROCESSED_COLUMNS if c not in ("descriptor", "status")
    ]
    rows = {r.unique_key: r for r in result.collect()}
    assert {k: r.resolution_hours for k, r in rows.items()} == {"1": 5.0, "2": 0.0, "3": 2.0}
    assert {k: r.is_closed for k, r in rows.items()} == {"1": True, "2": False, "3": True}
    assert {k: r.borough for k, r in rows.items()} == {
        "1": "MANHATTAN", "2": "BROOKLYN", "3": "QUEENS"
    }
    assert all(r.has_location and r.data_quality_score == 100 for r in rows.values())
    assert {r.created_weekday for r in rows.values()} == {"Friday"}
    assert reports.transform_summary(raw, result).first().asDict() == {
        "original_records": 4,
        "transformed_records": 3,
        "records_removed": 1,
        "columns_added": 10,
        "avg_quality_score": 100.0,
        "records_with_location": 3,
        "closed_complaints": 2,
    }


def test_single_open_request(spark):
    row = one(
        spark, unique_key="12345678", complaint_type="Noise - Street/Sidewalk",
        descriptor="Loud Music/Party",
    )
    assert list(row.asDict()) == list(S.PROCESSED_COLUMNS)
    assert row.resolution_hours == 0
    assert not row.is_closed
    assert row.closed_date is None
    assert (row.created_year, row.created_month, row.created_day, row.created_hour) == (2025, 1, 15, 10)
    assert row.created_weekday == "Wednesday"
    assert row.status == "OPEN"
    assert row.complaint_type == "NOISE - STREET/SIDEWALK"
    assert row.processed_at == RUN_TS
    assert row.data_quality_score == 100


def test_first_row_of_a_batch_wins_and_null_is_one_key(spark):
    rows = transform(
        raw_rows(
            spark,
            {"unique_key": "7", "agency": "first"},
            {"unique_key": "7", "agency": "second"},
            {"unique_key": None, "agency": "first"},
            {"unique_key": None, "agency": "second"},
        ),
        RUN_TS,
    ).collect()
    assert sorted((r.unique_key or "", r.agency) for r in rows) == [("", "FIRST"), ("7", "FIRST")]


@pytest.mark.parametrize("token", ["N/A", "NA", "None", "null", "", "NULL", "NaN", "#N/A"])
def test_missing_texts_become_unknown(spark, token):
    row = one(spark, agency=token)
    assert row.agency == "UNKNOWN"
    assert row.data_quality_score == 90


def test_token_list_can_be_emptied(spark):
    row = one(spark, TransformOptions(na_tokens=()), agency="None")
    assert row.agency == "NONE"


def test_blank_text_is_kept_and_scores(spark):
    row = one(spark, agency="   ")
    assert row.agency == ""
    assert row.data_quality_score == 100


def test_lookup_has_no_effect_after_upper_casing(spark):
    assert one(spark, borough="Staten Island").borough == "STATEN ISLAND"
    assert one(spark, borough="Hoboken").borough == "HOBOKEN"


def test_unspecified_borough_scores(spark):
    row = one(spark, borough="Unspecified")
    assert (row.borough, row.data_quality_score) == ("UNSPECIFIED", 100)


@pytest.mark.parametrize(
    ("latitude", "longitude", "want", "located"),
    [
        ("40.4", "-74.5", (40.4, -74.5), True),
        ("41.0", "-73.7", (41.0, -73.7), True),
        ("40.399", "-73.9", (0.0, 0.0), False),
        ("40.7", "-73.699", (0.0, 0.0), False),
        # A lone coordinate is kept, even outside the box.
        ("50.0", None, (50.0, 0.0), False),
        (None, "-73.9", (0.0, -73.9), False),
        ("abc", "-73.9", (0.0, -73.9), False),
        ("inf", "-73.9", (0.0, 0.0), False),
    ],
)
def test_coordinates(spark, latitude, longitude, want, located):
    row = one(spark, latitude=latitude, longitude=longitude)
    assert (row.latitude, row.longitude) == want
    assert row.has_location is located
    assert row.data_quality_score == (100 if located else 80)


def test_negative_duration_stays_closed(spark):
    row = one(spark, closed_date="2025-01-15 09:30:00")
    assert row.resolution_hours == 0
    assert row.is_closed


def test_status_is_not_consulted_for_closed(spark):
    assert not one(spark, status="Closed").is_closed


def test_fraction_of_hours_is_kept(spark):
    row = one(spark, closed_date="2025-01-15 10:30:00.5")
    assert row.resolution_hours == 0.5 / 3600


def test_unreadable_creation_time(spark):
    row = one(spark, created_date="yesterday")
    assert row.created_date is None
    assert (row.created_year, row.created_hour, row.created_weekday) == (0, 0, "UNKNOWN")
    assert row.data_quality_score == 80


def test_date_parts_stay_integers_beside_missing_dates(spark):
    kinds = dict(transform(raw_rows(spark, {"created_date": None}), RUN_TS).dtypes)
    assert {kinds[c] for c in ("created_year", "created_month", "created_day", "created_hour")} == {"int"}


def test_text_timestamps_and_back(spark):
    options = TransformOptions(timestamps_as_text=True)
    raw = raw_rows(
        spark,
        {"unique_key": "1", "created_date": "2025-01-15T10:30:00.999"},
        {"unique_key": "2", "created_date": "bad", "closed_date": "2025-01-16T00:00:00-05:00"},
    )
    shown = transform(raw, RUN_TS, options)
    assert {shown.schema[c].dataType.simpleString() for c in ("created_date", "closed_date", "processed_at")} == {"string"}
    rows = {r.unique_key: r for r in shown.collect()}
    assert rows["1"].created_date == "2025-01-15 10:30:00"
    assert rows["1"].closed_date == ""
    assert rows["2"].created_date is None
    assert rows["2"].closed_date == "2025-01-16 00:00:00"
    assert rows["2"].processed_at == "2025-11-01 12:00:00"
    restored = {r.unique_key: r for r in clean.restore_timestamps(shown).collect()}
    assert restored["1"].created_date == datetime(2025, 1, 15, 10, 30)
    assert restored["1"].closed_date is None
    assert restored["2"].closed_date == datetime(2025, 1, 16)


def test_text_frame_with_empty_closing_time(spark):
    frame = spark.createDataFrame(
        [
            (1, "2025-01-01 10:00:00", "2025-01-01 15:00:00", "Noise"),
            (2, "2025-01-02 11:00:00", "", "Heating"),
            (3, "2025-01-03 12:00:00", "2025-01-03 16:00:00", "Water"),
        ],
        "unique_key int, created_date string, closed_date string, complaint_type string",
    )
    rows = clean.restore_timestamps(frame).orderBy("unique_key").collect()
    assert [r.closed_date for r in rows] == [
        datetime(2025, 1, 1, 15), None, datetime(2025, 1, 3, 16)
    ]


def test_empty_batch_keeps_the_full_schema(spark):
    empty = transform(raw_rows(spark, {}).limit(0), RUN_TS)
    assert empty.columns == list(S.PROCESSED_COLUMNS)
    assert empty.count() == 0


def test_missing_mandatory_column_is_named(spark):
    with pytest.raises(ValueError, match="agency"):
        transform(raw_rows(spark, {}).drop("agency"), RUN_TS)


def test_optional_columns_are_created_or_left_out(spark):
    raw = raw_rows(spark, {}).drop("latitude", "longitude", "closed_date", "status")
    row = transform(raw, RUN_TS).first()
    assert "status" not in row.asDict()
    assert (row.latitude, row.longitude, row.closed_date, row.is_closed) == (0.0, 0.0, None, False)


def test_number_keys_become_text(spark):
    raw = raw_rows(spark, {"unique_key": "5"}).withColumn("unique_key", F.col("unique_key").cast("bigint"))
    assert transform(raw, RUN_TS).first().unique_key == "5"


def test_further_date_columns_are_parsed_and_dropped(spark):
    raw = raw_rows(spark, {}).withColumn("due_date", F.lit("01/02/2025"))
    assert clean.parse_timestamps(raw).schema["due_date"].dataType.simpleString() == "timestamp"
    assert "due_date" not in transform(raw, RUN_TS).columns


def test_fill_covers_listed_columns_of_wider_relations(spark):
    frame = spark.createDataFrame(
        [(None, None, None, None, None)],
        "city string, incident_zip int, is_closed boolean, x_coordinate string, other string",
    )
    assert clean.fill_missing(frame).first() == ("UNKNOWN", 0, False, "0", None)


def test_score_stays_in_range_and_steps(spark):
    scores = transform(raw_requests(spark, SMALL), RUN_TS).select("data_quality_score").distinct()
    values = {r[0] for r in scores.collect()}
    assert values and all(0 <= v <= 100 and v % 5 == 0 for v in values)


def test_transform_does_not_depend_on_partitioning(spark):
    raw = raw_requests(spark, SMALL)
    want = transform(raw, RUN_TS)
    got = transform(raw.repartition(7, "agency"), RUN_TS)
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_weights_and_box_are_parameters(spark):
    options = TransformOptions(
        weights={"unique_key": 60, "has_location": 40}, latitude_range=(0.0, 1.0)
    )
    row = one(spark, options)
    assert (row.latitude, row.data_quality_score) == (0.0, 60)
