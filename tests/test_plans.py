"""The plans keep their shape: one exchange per grouping, narrow scans, no Python."""

from __future__ import annotations

import pytest

from requestmill.operators import reports
from requestmill.plans import queries
from requestmill.plans.transform import transform

SMALL = "/root/testdata/sf0.001"
# Exchanges besides the one for the deduplication.
REPORT_EXCHANGES = {
    "total_rows": 1,
    "overall_stats": 1,
    "completeness_report": 1,
    "quality_bands": 1,
    "top_agencies": 1,
    "date_range": 1,
    "data_summary": 2,
    "quality_summary": 1,
    "closed_summary": 1,
    "column_stats": 1,
    "run_check": 1,
    "avg_quality": 1,
    "null_census": 1,
    "high_water_mark": 1,
    "latest_created": 0,
    "latest_processed_report": 0,
    "column_profile": 1,
    "cleaning_counts": 1,
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REPORT_EXCHANGES))
def test_report_exchanges(spark, name):
    plan = plan_of(queries.all_queries()[name](spark, SMALL))
    assert plan.count("Exchange ") == 1 + REPORT_EXCHANGES[name], plan
    assert "Join" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert "WindowGroupLimit" in plan


ROW_LEVEL = (
    "incremental_scan", "since_normalise", "full_backfill", "select_available",
    "parse_timestamps", "parse_numbers", "bounding_box", "normalise_text", "category_lookup",
    "date_parts", "resolution_hours", "status_flags", "fill_missing", "quality_score",
    "drop_empty_rows", "format_timestamps", "null_tokens", "na_tokens", "canonical_columns",
    "text_predicates", "json_payload", "union_by_name", "append_without_key", "epoch_ns_to_ts",
)


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_row_level_operators_do_not_shuffle(spark, name):
    plan = plan_of(queries.all_queries()[name](spark, SMALL))
    assert "Exchange" not in plan and "Python" not in plan


def test_top_n_is_not_a_sort(spark):
    for name in ("latest_created", "latest_processed_report", "top_agencies"):
        assert "TakeOrderedAndProject" in plan_of(queries.all_queries()[name](spark, SMALL))


def test_reports_read_only_their_columns(spark):
    plan = plan_of(queries.all_queries()["closed_summary"](spark, SMALL))
    assert "user_id" in plan
    narrow = plan_of(queries.all_queries()["total_rows"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint>" in narrow


def test_reports_on_a_written_master_push_down(spark, folder):
    transform(queries.raw_requests(spark, SMALL), queries.RUN_TS).write.parquet(f"{folder}/p")
    master = spark.read.parquet(f"{folder}/p")
    assert "ReadSchema: struct<data_quality_score:int>" in plan_of(reports.quality_bands(master))
    recent = reports.overall_stats(master.where("created_date >= TIMESTAMP '2024-01-20'"))
    plan = plan_of(recent)
    assert "GreaterThanOrEqual(created_date,2024-01-20" in plan
    assert "descriptor" not in plan
