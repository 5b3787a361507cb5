"""Fields beyond the schema: types, counts, and the values themselves."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import types as T

from requestmill.plans.increment import RunConfig, drift_report, run_increment
from requestmill.sources import drift

KNOWN = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
LINES = [
    '{"a": "x", "b": 1, "c": {"d": [1, null, {"e": "é"}]}}',
    '{"a": null, "b": "t", "c": 2.5}',
    '{"a": true, "n": 12345678901234567890, "c": "s"}',
    '{"a": "x", "a": "y"}',  # a field twice
    '[1, 2]',
    '"text"',
    '{"cut": ',
    "",
    None,
    "{}",
    '{"": 1, "with.dot": 2, "A": 3}',
]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(x, f"f{k}") for k, x in enumerate(LINES)]
    return spark.createDataFrame(rows, "value string, file string").repartition(3)


def test_field_counts(lines):
    rows = drift.field_counts(drift.as_records(lines), KNOWN).collect()
    got = {(r["field"], r["type"]): (r["is_known"], r["n_records"], r["least"], r["most"]) for r in rows}
    assert got == {
        ("a", "STRING"): (True, 1, "x", "x"),
        ("a", "VOID"): (True, 1, "null", "null"),
        ("a", "BOOLEAN"): (True, 1, "true", "true"),
        ("b", "DECIMAL"): (True, 1, "1", "1"),
        ("b", "STRING"): (True, 1, "t", "t"),
        ("c", "OBJECT"): (False, 1, '{"d":[1,null,{"e":"é"}]}', '{"d":[1,null,{"e":"é"}]}'),
        ("c", "DECIMAL"): (False, 1, "2.5", "2.5"),
        ("c", "STRING"): (False, 1, "s", "s"),
        ("n", "DECIMAL"): (False, 1, "12345678901234567890", "12345678901234567890"),
        ("", "DECIMAL"): (False, 1, "1", "1"),
        ("with.dot", "DECIMAL"): (False, 1, "2", "2"),
        ("A", "DECIMAL"): (False, 1, "3", "3"),
    }
    assert {r["n_all"] for r in rows} == {5}


def test_schema_of_all_records(lines):
    some = drift.as_records(lines.where("file IN ('f0', 'f1')"))
    (row,) = drift.landed_schema(some).collect()
    assert row["schema"].startswith("OBJECT<a: STRING, b: VARIANT, c: VARIANT")


def test_rescued_values(lines):
    rows = drift.with_rescued(lines, KNOWN).selectExpr("*", "to_json(_rescued) AS j").collect()
    got = {r["file"]: (r["a"], r["b"], r["j"] and json.loads(r["j"])) for r in rows}
    assert len(rows) == len(LINES)
    assert got["f0"] == ("x", "1", {"c": {"d": [1, None, {"e": "é"}]}})
    assert got["f1"] == (None, "t", {"c": 2.5})
    assert got["f2"] == ("true", None, {"c": "s", "n": 12345678901234567890})
    assert got["f10"] == (None, None, {"": 1, "with.dot": 2, "A": 3})
    assert all(got[f"f{k}"][2] is None for k in (3, 4, 5, 6, 7, 8, 9))


def test_none(lines):
    nothing = lines.where("false")
    assert drift.field_counts(drift.as_records(nothing), KNOWN).collect() == []
    assert drift.with_rescued(nothing, KNOWN).collect() == []


def test_runs_keep_what_they_find(spark, folder):
    config = RunConfig(f"{folder}/root", f"{folder}/landing", track_files=True, rescue=True)
    for n in range(2):
        path = Path(config.landing, f"{n}.json")
        path.parent.mkdir(exist_ok=True)
        record = {"unique_key": f"k{n}", "created_date": "2025-01-05T00:00:00", "agency": "A"}
        extra = {"channel": "web"} if n == 0 else {"channel": 7, "lat": [1, 2]}
        path.write_text(json.dumps(record | extra) + "\n" + json.dumps(record) + "\n")
        assert run_increment(spark, config, datetime(2025, 1, 10), f"r{n}")["status"] == "success"
    report = {(r["field"], r["type"]): r["n_records"] for r in drift_report(spark, config).where("NOT is_known").collect()}
    assert report == {("channel", "STRING"): 1, ("channel", "DECIMAL"): 1, ("lat", "ARRAY"): 1}
    assert {r["share"] for r in drift_report(spark, config).where("field = 'channel'").collect()} == {0.25}
    kept = spark.read.parquet(config.rescued_path).selectExpr("unique_key", "to_json(_rescued) AS j").collect()
    assert sorted(map(tuple, kept)) == [("k0", '{"channel":"web"}'), ("k1", '{"channel":7,"lat":[1,2]}')]
    with pytest.raises(ValueError):
        path.with_name("9.json").write_text("{}")
        run_increment(spark, replace(config, landing_format="csv"), datetime(2025, 1, 10), "r9")
