"""Column expressions against the Python or pandas behaviour they stand for."""

from __future__ import annotations

import math
import sys

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from requestmill.functions import numeric, temporal, text


def evaluate(spark, values, *expressions):
    """Each expression over a one-column relation ``x``, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").coalesce(1)
    shown = rows.select("i", *[e.alias(f"c{n}") for n, e in enumerate(expressions)])
    return [tuple(r)[1:] for r in shown.orderBy("i").collect()]


def test_whitespace_is_pythons():
    assert set(text.WHITESPACE) == {
        chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()
    }
    assert all(c.isascii() for c in text.ASCII_BLANKS)


BLANKS = st.text(st.sampled_from(text.WHITESPACE), max_size=3)
WORDS = st.text(st.sampled_from("abZ é一 \t-"), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(BLANKS, WORDS, BLANKS), min_size=20, max_size=60))
def test_clean_text_is_strip_and_upper(spark, parts):
    values = ["".join(p) for p in parts]
    got = evaluate(spark, values, text.strip_blanks(F.col("x")), text.clean_text(F.col("x")))
    assert got == [(v.strip(), v.strip().upper()) for v in values]


def test_clean_text_marker_and_blank(spark):
    got = evaluate(spark, [" nan ", "NaN", "banana", "   ", "", None], text.clean_text(F.col("x")))
    assert [r[0] for r in got] == [None, None, "BANANA", "", "", None]


NUMBERS = [
    "1", "-1.5", "+2", ".5", "5.", "1e3", "1E-2", " 40.7 ", "\t40.7\n", "1.0d", "1.0f", "2D",
    "0x1p3", "0x10", "nan", "NaN", "inf", "-inf", "Infinity", "INF", "abc", "", " ", "-", "1,000",
    "1_000", "40.7.1", "1e", "--1", "+-1", "1 2", "40.7°", "true",
]


def test_numbers_are_read_as_pandas_does(spark):
    got = [r[0] for r in evaluate(spark, NUMBERS, numeric.parse_number(F.col("x")))]
    want = [None if math.isnan(v) else v for v in pd.to_numeric(pd.Series(NUMBERS), errors="coerce")]
    assert dict(zip(NUMBERS, got)) == dict(zip(NUMBERS, want))


def test_numbers_in_full_precision(spark):
    values = ["40.758900123456789", "-73.98510000000001", "1.7976931348623157e308"]
    got = [r[0] for r in evaluate(spark, values, numeric.parse_number(F.col("x")))]
    assert got == [float(v) for v in values]


@pytest.mark.parametrize(
    ("shown", "want"),
    [
        ("2025-01-15 10:30:00", "2025-01-15 10:30:00"),
        ("2025-01-15T10:30:00.123", "2025-01-15 10:30:00.123"),
        ("2025-01-15", "2025-01-15 00:00:00"),
        ("01/15/2025 10:30:00 PM", "2025-01-15 22:30:00"),
        ("01/15/2025 22:30:00", "2025-01-15 22:30:00"),
        ("01/15/2025", "2025-01-15 00:00:00"),
        # The offset is dropped, whichever its sign.
        ("2025-01-15T10:00:00-05:00", "2025-01-15 10:00:00"),
        ("2025-01-15T10:00:00+05:00", "2025-01-15 10:00:00"),
        ("2025-01-15T10:00:00Z", "2025-01-15 10:00:00"),
        ("not-a-date", None),
        ("2025-02-30", None),
        ("2025-13-01 00:00:00", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamps(spark, shown, want):
    got = evaluate(spark, [shown], temporal.parse_timestamp(F.col("x")).cast("string"))
    assert got == [(want,)]


def test_mixed_timestamp_layouts_are_all_read(spark):
    values = ["01/15/2025 10:30:00 AM", "2025-01-15 10:30:00", "2025-01-15T10:30:00"]
    got = evaluate(spark, values, temporal.parse_timestamp(F.col("x")).cast("string"))
    assert got == [("2025-01-15 10:30:00",)] * 3


def test_epoch_nanoseconds(spark):
    values = ["1736937000123456789", "0", "-1", "2025-01-15 10:30:00", "bad", None, "12345678901234567890"]
    got = evaluate(spark, values, temporal.epoch_ns_to_timestamp(F.col("x")).cast("string"))
    assert [r[0] for r in got] == [
        "2025-01-15 10:30:00.123456",
        "1970-01-01 00:00:00",
        "1969-12-31 23:59:59.999999",
        "2025-01-15 10:30:00",
        None,
        None,
        None,
    ]


def test_since_and_hours(spark):
    got = evaluate(
        spark,
        ["2025-01-15 10:30:00.999", "2025-01-15T10:30:00", None],
        temporal.normalise_since(F.col("x")),
        temporal.hours_between(F.lit("2025-01-15 10:00:00").cast("timestamp"),
                               temporal.parse_timestamp(F.col("x"))),
    )
    assert got == [
        ("2025-01-15T10:30:00", 1800.999 / 3600),
        ("2025-01-15T10:30:00", 0.5),
        (None, None),
    ]


def test_filled_compare_preview_and_lookup(spark):
    long = "x" * 60
    got = evaluate(
        spark,
        ["Closed", "CLOSED", "", "   ", None, long],
        text.is_filled(F.col("x")),
        text.equals_ignoring_case(F.col("x"), "closed"),
        text.preview(F.col("x")),
        text.look_up(F.col("x"), {"Closed": "DONE"}),
    )
    assert got == [
        (True, True, "Closed...", "DONE"),
        (True, True, "CLOSED...", "CLOSED"),
        (False, False, "...", ""),
        (False, False, "   ...", "   "),
        (False, None, None, None),
        (True, False, "x" * 50 + "...", long),
    ]


def test_lookup_with_nothing_to_replace(spark):
    assert evaluate(spark, ["a"], text.look_up(F.col("x"), {})) == [("a",)]


def test_percent_of_nothing_is_null(spark):
    got = evaluate(
        spark,
        ["1"],
        numeric.percent_of(F.lit(1), F.lit(3)),
        numeric.percent_of(F.lit(0), F.lit(0)),
    )
    assert got == [(33.3, None)]


def test_tokens_with_quotes_and_odd_column_names(spark):
    tokens = ("it's", "back\\slash", "plain")
    frame = spark.createDataFrame([(t,) for t in (*tokens, "kept", " plain")], "`a b``c` string")
    got = [r[0] for r in frame.select(text.null_if_token("a b`c", tokens)).collect()]
    assert got == [None, None, None, "kept", " plain"]
