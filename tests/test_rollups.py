"""Reports from parts against the same reports over the whole master."""

from __future__ import annotations

import pytest

from requestmill import schemas as S
from requestmill.operators import reports
from requestmill.plans import rollups
from requestmill.plans.rollups import Bands, Rollup
from requestmill.plans.sample_data import increments
from requestmill.plans.transform import transform
from requestmill.sources.master import Layout, Master

RUN_TS = "2025-01-02 03:04:05"
SMALL = "/root/testdata/sf0.001"
REPORTS = {
    "total_rows": reports.total_rows,
    "overall_stats": reports.overall_stats,
    "completeness": reports.completeness,
    "quality_bands": reports.quality_bands,
    "top_agencies": reports.top_agencies,
    "date_range": reports.date_range,
    "data_summary": reports.data_summary,
    "quality_summary": reports.quality_summary,
    "closed_summary": reports.closed_summary,
    "column_stats": reports.column_stats,
    "run_check": reports.run_check,
    "average_quality": reports.average_quality,
    "high_water_mark": reports.high_water_mark,
}


LACKING = [f"CAST(NULL AS STRING) AS {c}" for c in S.RAW_COLUMNS if c not in ("unique_key", "created_date", "agency")]


def master_in(spark, folder, layout):
    return Master(spark, f"{folder}/master", S.PROCESSED_SCHEMA, layout)


def merge(spark, master, rows, path):
    transform(rows, RUN_TS).write.mode("overwrite").parquet(path)
    master.merge(spark.read.parquet(path))


def compare(master, rollup):
    whole = master.read().cache()
    for name, report in REPORTS.items():
        got, want = getattr(rollup, name)(), report(whole)
        assert got.columns == want.columns, name
        assert got.dtypes == want.dtypes, name
        assert got.collect() == want.collect(), name
        assert not [f for f in got.inputFiles() if "/master/" in f], name
    whole.unpersist()


@pytest.mark.parametrize("layout", [Layout("time"), Layout("buckets", buckets=4)])
def test_three_merges_with_moved_rows(spark, folder, layout):
    master = master_in(spark, folder, layout)
    rollup = Rollup(master, f"{folder}/rollup")
    compare(master, rollup)  # nothing merged yet
    first, second = increments(spark, SMALL)
    merge(spark, master, first, f"{folder}/1")
    assert set(rollup.refresh()) == set(master.pointer()["partitions"])
    compare(master, rollup)
    merge(spark, master, second, f"{folder}/2")
    rollup.refresh()
    compare(master, rollup)
    moved = first.where("unique_key IN ('10', '20', '30')").selectExpr(
        "* EXCEPT (created_date, agency)", "'2024-03-03T00:00:00' AS created_date", "'a new one' AS agency"
    )
    before = master.pointer()["partitions"]
    merge(spark, master, moved, f"{folder}/3")
    changed = {p for p, v in master.pointer()["partitions"].items() if before.get(p) != v}
    assert set(rollup.refresh()) == changed  # no other partition's rows are read
    if layout.kind == "time":
        assert 1 < len(changed) < len(before)
    compare(master, rollup)
    assert rollup.refresh() == []


def test_a_partition_that_empties(spark, folder):
    """All rows of one day move to another; the day's parts go."""
    master = master_in(spark, folder, Layout("time"))
    rollup = Rollup(master, f"{folder}/rollup")
    rows = [("1", "2024-01-01T00:00:00", "A"), ("2", "2024-01-02T00:00:00", "B")]
    schema = "unique_key string, created_date string, agency string"
    for n, batch in enumerate((rows, [("1", "2024-01-02T05:00:00", "C")])):
        raw = spark.createDataFrame(batch, schema).selectExpr("*", f"{n}L AS seq", *LACKING)
        merge(spark, master, raw, f"{folder}/{n}")
        rollup.refresh()
        compare(master, rollup)
    assert [r["part"] for r in rollup.measures().collect()] == list(master.pointer()["partitions"])
    assert {r["agency"] for r in rollup.top_agencies().collect()} == {"B", "C"}


def test_many_refreshes_fold(spark, folder, monkeypatch):
    monkeypatch.setattr(rollups, "FOLD_AT", 3)
    master = master_in(spark, folder, Layout("time"))
    rollup = Rollup(master, f"{folder}/rollup")
    for n in range(7):
        raw = spark.createDataFrame([(str(n), f"2024-01-0{n + 1}T00:00:00", n)], "unique_key string, created_date string, seq long")
        raw = raw.selectExpr("*", "'A' AS agency", *LACKING)
        merge(spark, master, raw, f"{folder}/{n}")
        rollup.refresh()
    compare(master, rollup)
    assert len({x["in"] for x in rollup._pointer()["parts"].values()}) < 3


def test_a_refresh_that_dies_changes_nothing(spark, folder, monkeypatch):
    master = master_in(spark, folder, Layout("time"))
    rollup = Rollup(master, f"{folder}/rollup")
    first, second = increments(spark, SMALL)
    merge(spark, master, first, f"{folder}/1")
    rollup.refresh()
    kept = rollup.overall_stats().collect()
    merge(spark, master, second, f"{folder}/2")

    def die(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(rollups.files, "write_document", die)
        with pytest.raises(OSError):
            rollup.refresh()
    assert rollup.overall_stats().collect() == kept
    rollup.refresh()
    compare(master, rollup)


def test_other_bands_need_another_rollup(spark, folder):
    master = master_in(spark, folder, Layout("time"))
    first, _ = increments(spark, SMALL)
    merge(spark, master, first, f"{folder}/1")
    Rollup(master, f"{folder}/rollup").refresh()
    other = Bands(high=70, medium=20, closed="open")
    with pytest.raises(ValueError):
        Rollup(master, f"{folder}/rollup", other).refresh()
    rollup = Rollup(master, f"{folder}/other", other)
    rollup.refresh()
    assert rollup.quality_bands().collect() == reports.quality_bands(master.read(), 70, 20).collect()
    assert rollup.closed_summary().collect() == reports.closed_summary(master.read(), "open").collect()


@pytest.mark.parametrize("n", [1, 5, 40, 10_000])
def test_newest_rows_read_few_partitions(spark, folder, n):
    """Ties of the n-th row, NULL dates and rows of several batches, against the whole master."""
    master = master_in(spark, folder, Layout("time"))
    rollup = Rollup(master, f"{folder}/rollup")
    assert rollup.newest_parts(n) == {}
    first, second = increments(spark, SMALL)
    for k, batch in enumerate((first, second)):
        path = f"{folder}/{k}"
        transform(batch.where("seq < 60" if k else "true"), f"2025-01-0{k + 1} 00:00:00").write.parquet(path)
        master.merge(spark.read.parquet(path))
    tied = [(f"t{k}", "2024-01-20T00:00:00", "A", 900_000 + k) for k in range(7)] + [("none", None, "A", 1_000_000)]
    raw = spark.createDataFrame(tied, "unique_key string, created_date string, agency string, seq long")
    merge(spark, master, raw.selectExpr("*", *LACKING), f"{folder}/t")
    rollup.refresh()
    whole = master.read().cache()
    assert rollup.latest_created(n).collect() == reports.latest_created(whole, n).collect()
    assert rollup.latest_processed(n).collect() == reports.latest_processed(whole, n).collect()
    if n < 10:
        assert len(rollup.newest_parts(n)) < len(master.pointer()["partitions"]) / 2
        assert len(rollup.latest_created(n).inputFiles()) <= 2
    whole.unpersist()
