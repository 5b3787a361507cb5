"""Merge properties, and the master dataset."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill.operators import dedup
from requestmill.plans.sample_data import increments
from requestmill.sources import files
from requestmill.sources.master import Layout, Master

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("unique_key", T.StringType()),
        T.StructField("created_date", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)
KEYS = st.sampled_from([None, "a", "b", "c", "d"])


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def keyed(spark, keys, batch):
    rows = [(k, batch, i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "unique_key string, batch_id int, seq int")


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(KEYS, max_size=8), st.lists(KEYS, max_size=8))
def test_both_merges_agree_with_a_dictionary(spark, old, new):
    existing = dedup.dedup_last(keyed(spark, old, 1))
    increment = keyed(spark, new, 2)
    want = {k: (1, i) for i, k in enumerate(old)} | {k: (2, i) for i, k in enumerate(new)}
    merges = (
        dedup.merge_keep_last(existing, increment),
        dedup.merge_anti_join(existing, increment),
        dedup.merge_anti_join(existing, increment, broadcast=True),
    )
    for merged in merges:
        rows = merged.collect()
        assert len(rows) == len(want)
        assert {r.unique_key: (r.batch_id, r.seq) for r in rows} == want


def test_merge_is_idempotent_and_free_of_partitioning(spark):
    first, second = increments(spark, SMALL)
    once = dedup.merge_keep_last(first, second)
    assert same(dedup.merge_keep_last(once, second), once)
    assert same(dedup.merge_keep_last(first.repartition(5), second.repartition(3)), once)
    assert same(dedup.merge_anti_join(first, second), once)


def test_subset_schema(spark):
    three = spark.createDataFrame(
        [(1, "2025-01-01", "Noise"), (2, "2025-01-02", "Heating"), (3, "2025-01-03", "Water")],
        "unique_key int, created_date string, complaint_type string",
    ).withColumn("seq", F.col("unique_key"))
    changed = three.where("unique_key > 1").withColumn("complaint_type", F.lit("Other"))
    merged = dedup.merge_keep_last(
        three.withColumn("batch_id", F.lit(1)), changed.withColumn("batch_id", F.lit(2))
    )
    assert {r.unique_key: r.complaint_type for r in merged.collect()} == {
        1: "Noise", 2: "Other", 3: "Other"
    }


def test_a_key_with_a_third_of_the_rows_is_reduced_before_the_exchange(spark):
    rows = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("unique_key"),
        F.col("id").alias("seq"),
    )
    result = dedup.dedup_last(rows)
    plan = result._jdf.queryExecution().executedPlan().toString()
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert exchange < limit, "the limit has to lie below the exchange"
    assert result.count() == 20001
    assert result.where("unique_key = 'hot'").first().seq == 29997
    counts = dedup.duplicate_counts(rows).first()
    assert tuple(counts) == (30000, 20001, 9999)


def batch(spark, *rows):
    """Rows of (key, created, value)."""
    frame = spark.createDataFrame([(k, c, v) for k, c, v in rows], "unique_key string, c string, value string")
    return frame.select("unique_key", F.col("c").cast("timestamp").alias("created_date"), "value")


def content(master):
    return {r.unique_key: (str(r.created_date), r.value) for r in master.read().collect()}


FIRST = [
    ("1", "2025-01-01 10:00:00", "a"),
    ("2", "2025-01-02 10:00:00", "a"),
    ("3", "2025-01-03 10:00:00", "a"),
    (None, None, "a"),
]
# 2 moves to another day, 4 is new, NULL comes again with a time.
SECOND = [
    ("2", "2025-01-03 09:00:00", "b"),
    ("4", "2025-01-04 10:00:00", "b"),
    (None, "2025-01-04 11:00:00", "b"),
]
MERGED = {
    "1": ("2025-01-01 10:00:00", "a"),
    "2": ("2025-01-03 09:00:00", "b"),
    "3": ("2025-01-03 10:00:00", "a"),
    "4": ("2025-01-04 10:00:00", "b"),
    None: ("2025-01-04 11:00:00", "b"),
}
LAYOUTS = [
    Layout("time"),
    Layout("time", unit="month"),
    Layout("time", unit="hour"),
    Layout("buckets", buckets=3),
]


@pytest.mark.parametrize(
    ("layout", "broadcast_bytes", "fmt"),
    [(layout, size, "parquet") for layout in LAYOUTS for size in (0, 1 << 20)]
    + [(LAYOUTS[0], 0, "csv"), (LAYOUTS[3], 1 << 20, "csv")],
)
def test_master_merges(spark, folder, layout, broadcast_bytes, fmt):
    master = Master(spark, folder, SCHEMA, layout, fmt, broadcast_bytes=broadcast_bytes)
    assert master.read().columns == SCHEMA.names
    assert master.read().count() == 0
    assert master.merge(batch(spark, *FIRST)).strategy == "first"
    result = master.merge(batch(spark, *SECOND))
    assert result.strategy == ("anti_join" if broadcast_bytes else "union")
    assert content(master) == MERGED
    assert master.read().count() == len(MERGED)
    master.merge(batch(spark, *SECOND))
    assert content(master) == MERGED
    assert master.read().count() == len(MERGED)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_master_keeps_the_last_of_repeated_keys(spark, folder, broadcast_bytes):
    master = Master(spark, folder, SCHEMA, broadcast_bytes=broadcast_bytes)
    for _ in range(2):
        rows = batch(spark, ("1", "2025-01-01", "x"), ("1", "2025-01-05", "y")).withColumn(
            "seq", F.when(F.col("value") == "y", 2).otherwise(1)
        )
        master.merge(rows, order=("seq",))
        assert content(master) == {"1": ("2025-01-05 00:00:00", "y")}


def test_only_touched_partitions_are_rewritten(spark, folder):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    result = master.merge(batch(spark, ("5", "2025-01-03 12:00:00", "b")))
    assert result.partitions_written == 1
    places = {p: v.split("-")[0] for p, v in master.pointer()["partitions"].items()}
    assert places == {
        "2025-01-01": "v=1", "2025-01-02": "v=1", "2025-01-03": "v=2", "none": "v=1"
    }


def test_emptied_partition_leaves_the_pointer(spark, folder):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    master.merge(batch(spark, *SECOND))
    assert sorted(master.pointer()["partitions"]) == ["2025-01-01", "2025-01-03", "2025-01-04"]


def test_rows_that_never_move_need_no_lookup(spark, folder, monkeypatch):
    master = Master(spark, folder, SCHEMA, Layout(rows_move=False))
    master.merge(batch(spark, *FIRST))
    read = []
    original = Master._read_partitions
    monkeypatch.setattr(Master, "_read_partitions", lambda self, f: read.append(sorted(f)) or original(self, f))
    master.merge(batch(spark, ("3", "2025-01-03 12:00:00", "b")))
    assert read == [["2025-01-03"]]
    assert content(master)["3"] == ("2025-01-03 12:00:00", "b")


def test_key_lookup_is_pushed_to_the_scan(spark, folder):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    rows = batch(spark, ("2", "2025-01-05", "b"), (None, None, "b"))
    keys = master._measure(master._as_stored(rows, 2))
    assert (keys.rows, keys.lowest, keys.highest, keys.any_null) == (2, "2", "2", True)
    looked_up = master._read_partitions(master.pointer()["partitions"]).where(keys.within("unique_key"))
    plan = looked_up.select("part")._jdf.queryExecution().executedPlan().toString()
    assert "Or(And(GreaterThanOrEqual(unique_key,2),LessThanOrEqual(unique_key,2)),IsNull(unique_key))" in plan
    assert "ReadSchema: struct<unique_key:string>" in plan


def test_reading_by_time_opens_the_named_days_only(spark, folder):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    rows = master.read("2025-01-02", "2025-01-03")
    assert [r.unique_key for r in rows.collect()] == ["2"]
    assert all("part=2025-01-02" in name for name in rows.inputFiles())
    assert {r.unique_key for r in master.read(start="2025-01-02").collect()} == {"2", "3"}
    assert {r.unique_key for r in master.read(end="2025-01-02").collect()} == {"1"}
    with pytest.raises(ValueError):
        Master(spark, folder, SCHEMA, Layout("buckets")).read("2025-01-02")


def test_a_run_that_dies_before_the_pointer_changes_nothing(spark, folder, monkeypatch):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    before = content(master)

    def fail(*_):
        raise OSError("disk gone")

    with monkeypatch.context() as patch:
        patch.setattr(files, "write_document", fail)
        with pytest.raises(OSError):
            master.merge(batch(spark, *SECOND))
    assert content(master) == before
    assert master.pointer()["version"] == 1
    master.merge(batch(spark, *SECOND))
    assert content(master) == MERGED


def test_unreadable_pointer_is_not_a_first_load(spark, folder):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    Path(folder, "current.json").write_text("{ broken")
    Path(folder, ".current.json.crc").unlink(missing_ok=True)
    with pytest.raises(json.JSONDecodeError):
        master.merge(batch(spark, *SECOND))
    Path(folder, "current.json").write_text("")
    with pytest.raises(ValueError):
        master.read()


def test_second_writer_is_noticed(spark, folder, monkeypatch):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    original = Master._write

    def write_and_be_overtaken(self, merged, path):
        original(self, merged, path)
        files.write_document(spark, self._pointer_path, {"version": 9, "partitions": {}})

    monkeypatch.setattr(Master, "_write", write_and_be_overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        master.merge(batch(spark, *SECOND))


def test_the_first_of_two_writers_wins(spark, folder, monkeypatch):
    """A commits while B merges: B raises, and A's rows are there and can be read."""
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    original = Master._write

    def write_and_be_overtaken(self, merged, path):
        original(self, merged, path)
        monkeypatch.setattr(Master, "_write", original)
        Master(spark, folder, SCHEMA).merge(batch(spark, ("9", "2025-01-03", "of A")))

    monkeypatch.setattr(Master, "_write", write_and_be_overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        master.merge(batch(spark, ("9", "2025-01-03", "of B"), ("8", "2025-01-01", "of B")))
    found = content(master)
    assert found["9"][1] == "of A" and "8" not in found and len(found) == len(FIRST) + 1
    master.merge(batch(spark, ("8", "2025-01-01", "again")))
    assert content(master)["8"][1] == "again"


def test_a_claim_is_taken_once_and_taken_over_when_old(spark, folder):
    path = f"{folder}/claims/5"
    assert files.claim(spark, path, 600)
    assert not files.claim(spark, path, 600)
    assert files.claim(spark, path, -1)


@pytest.mark.parametrize(
    "other", [Layout("buckets", buckets=7), Layout("time"), Layout("buckets", buckets=4)]
)
def test_another_layout_is_refused(spark, folder, other):
    master = Master(spark, folder, SCHEMA, Layout("buckets", buckets=4))
    master.merge(batch(spark, *FIRST))
    again = Master(spark, folder, SCHEMA, other)
    if other == Layout("buckets", buckets=4):
        again.merge(batch(spark, *FIRST))
        assert len(content(again)) == len(FIRST)
        with pytest.raises(ValueError, match="laid out"):
            Master(spark, folder, SCHEMA, other, "csv").read()
    else:
        for use in (again.read, lambda: again.merge(batch(spark, *FIRST))):
            with pytest.raises(ValueError, match="laid out"):
                use()


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_repeated_keys_without_an_order(spark, folder, broadcast_bytes):
    master = Master(spark, folder, SCHEMA, broadcast_bytes=broadcast_bytes)
    rows = [("1", "2025-01-01", "x"), ("1", "2025-01-05", "y"), ("1", "2025-01-05", "w")]
    for _ in range(2):
        master.merge(batch(spark, *rows))
        assert [tuple(r)[2] for r in master.read().collect()] == ["y"]


def test_files_are_sorted_and_row_groups_skipped(spark, folder):
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "lpad(cast(id as string), 8, '0') AS unique_key",
        "timestamp'2025-01-01' AS created_date",
        "sha2(cast(id as string), 256) AS value",
    )
    master = Master(spark, folder, SCHEMA)
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        master.merge(rows)
    finally:
        spark.conf.unset("parquet.block.size")
    import pyarrow.parquet as pq

    found = [p for p in Path(folder, "data").rglob("*.parquet")]
    for path in found:
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("unique_key")
        stats = [meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups)]
        assert [s.min for s in stats] == sorted(s.min for s in stats)
        assert all(a.max < b.min for a, b in zip(stats, stats[1:], strict=False))
        holding = [s for s in stats if s.min <= "00000007" <= s.max]
        assert len(holding) <= 1


def test_vacuum_removes_replaced_partitions(spark, folder):
    master = Master(spark, folder, SCHEMA)
    master.merge(batch(spark, *FIRST))
    for n in range(5):
        master.merge(batch(spark, ("2", "2025-01-02 10:00:00", str(n))))
    before = content(master)
    assert master.vacuum(grace=3600) == 0
    assert master.vacuum(grace=0) == 5
    assert content(master) == before
    used = {f"{v}/part={p}" for p, v in master.pointer()["partitions"].items()}
    there = {
        f"{d.parent.name}/{d.name}" for d in Path(folder, "data").glob("v=*/part=*") if d.is_dir()
    }
    assert there == used
    assert master.vacuum(grace=0) == 0


def test_unknown_layout():
    with pytest.raises(ValueError):
        Layout("weeks")
    with pytest.raises(ValueError):
        Layout("time", unit="week")


def test_a_partition_with_most_rows_is_written_by_several_tasks(spark, folder):
    rows = spark.range(0, 200000, 1, 8).select(
        F.col("id").cast("string").alias("unique_key"),
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("created_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        master = Master(spark, folder, SCHEMA)
        master.merge(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    place = f"{folder}/data/{master.pointer()['partitions']['2025-01-01']}/part=2025-01-01"
    written = [n for n in files.child_names(spark, place) if n.startswith("part-")]
    assert len(written) > 1
    assert master.read().count() == 200000
