"""The rules' numbers and names as plain literals, so that a changed constant is noticed."""

from __future__ import annotations

from requestmill import schemas as S


def test_limits_and_required_columns():
    assert S.TEXT_LIMITS == {
        "unique_key": 50,
        "agency": 50,
        "complaint_type": 100,
        "descriptor": 200,
        "borough": 50,
        "created_weekday": 20,
        "status": 50,
    }
    assert tuple(S.REQUIRED_COLUMNS) == ("unique_key", "created_date")


def test_weights_of_the_score():
    assert S.SCORE_WEIGHTS == {
        "unique_key": 25,
        "created_date": 20,
        "has_location": 20,
        "complaint_type": 15,
        "agency": 10,
        "borough": 10,
    }


def test_order_of_the_processed_columns():
    assert list(S.PROCESSED_COLUMNS) == [
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
        "created_year",
        "created_month",
        "created_day",
        "created_hour",
        "created_weekday",
        "resolution_hours",
        "is_closed",
        "has_location",
        "processed_at",
        "data_quality_score",
    ]
