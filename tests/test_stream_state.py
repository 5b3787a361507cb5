"""First row of each key with its keys in a state store: restarts, expiry, late rows, the exact route."""

from __future__ import annotations

import json
import time
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest

from requestmill.plans.increment import RunConfig
from requestmill.streaming import increments as streams
from requestmill.streaming.increments import StateConfig, stream_first_by_state


def land(config, name, *rows):
    """(key, created, agency) records in one file; a plain text is a line as it is."""
    path = Path(config.landing, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [
        r if isinstance(r, str) else json.dumps(dict(zip(("unique_key", "created_date", "agency"), r)))
        for r in rows
    ]
    path.write_text("".join(f"{x}\n" for x in lines))


def run(spark, config, **held):
    query = stream_first_by_state(
        spark, config, f"{config.root}/first", None, files_per_batch=1, held=StateConfig(**held)
    )
    query.awaitTermination()
    return query


def content(spark, config):
    rows = spark.read.parquet(f"{config.root}/first").collect()
    return sorted(((r["unique_key"], r["agency"]) for r in rows), key=repr)


def days_ago(n):
    moment = datetime.now(UTC).replace(tzinfo=None, microsecond=0) - timedelta(days=n)
    return moment.isoformat()


@pytest.fixture
def looked_up(monkeypatch):
    """(rows, folders) of each lookup in what was written."""
    calls = []
    real = streams._not_in

    def noted(rows, folders):
        calls.append((rows.count(), len(folders)))
        return real(rows, folders)

    monkeypatch.setattr(streams, "_not_in", noted)
    return calls


def test_restart_and_no_reading_of_history(spark, folder, looked_up):
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    land(config, "1.json", ("a", days_ago(0), "first"), ("b", days_ago(0), "first"), ("a", days_ago(0), "second"))
    run(spark, config, span="3650 days")
    for n in range(2, 5):  # a restart for each landing
        land(config, f"{n}.json", ("a", days_ago(0), "later"), (f"new{n}", days_ago(0), "first"))
        query = run(spark, config, span="3650 days")
    assert content(spark, config) == [("a", "first"), ("b", "first"), *((f"new{n}", "first") for n in (2, 3, 4))]
    # what was written was never joined: rows beyond the state come without rows, rows ahead without folders
    assert all(rows == 0 or folders == 0 for rows, folders in looked_up)
    operators = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    assert operators and any("rocksdb" in k.lower() for k in operators[-1][0]["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != streams.ROCKSDB[
        "spark.sql.streaming.stateStore.providerClass"
    ]


def test_late_and_undated_rows_take_the_exact_route(spark, folder, looked_up):
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    old = "1999-05-05T00:00:00"
    land(config, "1.json", ("a", old, "first"), ("u", None, "first"), (None, None, "no key"))
    run(spark, config, span="10 days")
    land(config, "2.json", ("late", old, "first"), ("n", days_ago(0), "first"))
    run(spark, config, span="10 days")
    assert content(spark, config) == [("a", "first"), ("late", "first"), ("n", "first"), ("u", "first"), (None, "no key")]
    assert (1, 1) in looked_up  # one late row, one batch before


def test_expired_keys_are_found_in_what_was_written(spark, folder):
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    land(config, "1.json", ("a", "2020-01-01T00:00:00", "first"), ("u", None, "first"), (None, None, "first"))
    run(spark, config, span="1 second")
    totals = []
    for n in range(2, 5):
        time.sleep(1.2)
        land(config, f"{n}.json", ("a", "2020-01-01T00:00:00", "again"), ("u", None, "again"), (None, None, "again"), (f"k{n}", None, "first"))
        query = run(spark, config, span="1 second")
        totals += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert content(spark, config) == [("a", "first"), *((f"k{n}", "first") for n in (2, 3, 4)), ("u", "first"), (None, "first")]
    assert max(totals) <= 12 and min(totals) < 8  # windows that are over leave the state


def test_keys_that_move(spark, folder):
    """A second row of a key with a new creation time in a later window: looked up if keys may move."""
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    land(config, "1.json", ("a", "2001-01-01T00:00:00", "first"))
    run(spark, config, span="1 second", keys_move=True)
    time.sleep(1.2)
    land(config, "2.json", ("a", days_ago(0), "again"), ("b", days_ago(0), "first"))
    run(spark, config, span="1 second", keys_move=True)
    assert content(spark, config) == [("a", "first"), ("b", "first")]


def test_rows_from_the_future_are_known_later(spark, folder):
    """A key that came before its creation time is found when it comes again after it."""
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    soon = (datetime.now(UTC).replace(tzinfo=None, microsecond=0) + timedelta(seconds=4)).isoformat()
    land(config, "1.json", ("f", soon, "first"))
    run(spark, config, span="1 second")
    time.sleep(4.5)
    land(config, "2.json", ("f", soon, "again"), ("g", days_ago(0), "first"))
    run(spark, config, span="1 second")
    assert content(spark, config) == [("f", "first"), ("g", "first")]


def test_unreadable_records_are_kept(spark, folder):
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    land(config, "1.json", ("a", None, "first"), '{"unique_key": "cut', '{"unique_key": "other cut')
    run(spark, config)
    assert content(spark, config) == [("a", "first")]
    found = spark.read.parquet(config.rejects_path).collect()
    assert sorted(r["record"] for r in found) == ['{"unique_key": "cut', '{"unique_key": "other cut']


def test_hot_keys_are_reduced_before_the_exchange(spark, folder):
    config = RunConfig(f"{folder}/root", f"{folder}/landing")
    land(config, "1.json", *[("hot", days_ago(0), "A") for _ in range(3_000)], ("cold", days_ago(0), "A"))
    query = run(spark, config)
    plan = query._jsq.explainInternal(False)
    assert "partial_min_by" in plan and plan.index("StateStoreSave") < plan.index("Exchange") < plan.index("partial_min_by")
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert progress[0]["stateOperators"][0]["numRowsUpdated"] == 2
    assert content(spark, config) == [("cold", "A"), ("hot", "A")]
