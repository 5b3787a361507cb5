"""Mappings of any size, and what is refused."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from requestmill.operators import clean, lookup


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, "a"), (2, "b"), (3, None), (4, ""), (5, "zz"), (6, "a"), (7, "void")]
    return spark.createDataFrame(rows, "id int, name string").selectExpr("*", "id * 2 AS `key`", "1 AS _x")


def test_same_as_the_literal_map(spark, texts):
    pairs = {"a": "A", "b": "", "": "blank", "other": "o"}
    frame = spark.createDataFrame([*pairs.items(), (None, "null"), ("a", "A")], "key string, value string")
    mapping = lookup.checked(frame)
    want = values(clean.category_lookup(texts, "name", pairs))
    for limit in (lookup.BROADCAST_BYTES, 0):
        found = lookup.look_up(texts, "name", mapping, limit)
        assert found.columns == texts.columns and values(found) == want


def test_values_that_are_null_pass_through(spark, texts):
    frame = spark.createDataFrame([("void", None), ("void", None), ("a", "x")], "key string, value string")
    found = lookup.look_up(texts, "name", lookup.checked(frame))
    assert {r["id"]: r["name"] for r in found.collect()}[7] == "void"


@pytest.mark.parametrize("second", ["other", None])
def test_repeated_keys_are_refused(spark, second):
    frame = spark.createDataFrame([("a", "x"), ("a", second), ("b", "y")], "key string, value string")
    with pytest.raises(ValueError, match="1 keys have several values, 'a'"):
        lookup.checked(frame)


def test_no_pairs_and_no_column(spark, texts):
    nothing = lookup.checked(spark.createDataFrame([], "key string, value string"))
    assert values(lookup.look_up(texts, "name", nothing)) == values(texts)
    assert lookup.look_up(texts, "absent", nothing) is texts


def test_a_million_pairs_both_ways(spark):
    pairs = spark.range(1_000_000).selectExpr("concat('k', id) AS key", "concat('v', id * 7) AS value")
    mapping = lookup.checked(pairs)
    assert 60_000_000 < mapping.n_bytes < 100_000_000
    # a third of all rows have one value
    rows = spark.range(60_000).selectExpr("id", "IF(id % 3 = 0, 'k5', concat('k', id * 40)) AS name")
    small = lookup.look_up(rows, "name", mapping, 1 << 30)
    large = lookup.look_up(rows, "name", mapping, 32 << 20)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    want = F.when(F.col("id") % 3 == 0, "v35").when(F.col("id") < 25_000, F.concat(F.lit("v"), F.col("id") * 280))
    want = rows.withColumn("name", F.coalesce(want, F.col("name")))
    for found in (small, large):
        assert found.exceptAll(want).isEmpty() and found.count() == 60_000
