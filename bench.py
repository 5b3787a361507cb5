"""Time the headline queries: one warm-up, then the median of three runs each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from requestmill.plans.queries import all_queries  # noqa: E402
from requestmill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
QUERIES = (
    "incremental_scan",
    "dedup_first",
    "duplicate_counts",
    "transform_full",
    "merge_keep_last",
    "merge_anti_join",
    "merge_processed",
    "overall_stats",
    "completeness_report",
    "quality_bands",
    "top_agencies",
    "data_summary",
    "column_profile",
    "null_census",
    "latest_created",
    "transform_summary",
    "contract_violations",
    "json_landing",
    "csv_roundtrip",
    "parquet_ms_roundtrip",
    "full_refresh_table",
    "merge_master_buckets",
    "increment_run",
    "stream_transform",
)


def run_once(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = tempfile.mkdtemp(prefix="requestmill-bench-")
    spark = build_session(
        "requestmill-bench",
        spark__master=f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=CPUS,
        spark__checkpoint__dir=folder,
        spark__sql__warehouse__dir=f"{folder}/warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    seconds = {}
    for name in QUERIES:
        run_once(known[name], spark)
        seconds[name] = round(statistics.median(run_once(known[name], spark) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    raw_rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    rate = {
        n: round(raw_rows / seconds[n]) for n in ("transform_full", "merge_keep_last", "increment_run")
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rate,
                "raw_rows": raw_rows,
                "cpus": int(CPUS),
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
