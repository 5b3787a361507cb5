"""Counts and joins of texts that differ in case and blanks at the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestmill.operators.collated import collated, value_counts


def counts(spark, *texts, **more):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r["value"]: (r["n_rows"], r["n_spellings"]) for r in value_counts(rows, "text", **more).collect()}


def test_value_counts(spark):
    found = counts(spark, "Noise", "NOISE", "NOISE  ", "NOISE", "noise", None, None, "", "  ", " noise", "é", "É")
    # equally frequent spellings: the first by bytes; blanks in front count
    assert found == {"NOISE": (5, 4), None: (2, 1), "": (2, 2), " noise": (1, 1), "É": (2, 2)}
    assert counts(spark) == {}
    assert counts(spark, "a", "A", "a ", collation="UTF8_LCASE") == {"A": (2, 2), "a ": (1, 1)}


def test_join_and_distinct(spark):
    left = spark.createDataFrame([("Bronx",), ("bronx ",), (None,)], "a string")
    right = spark.createDataFrame([("BRONX", 1), ("Queens", 2), (None, 3)], "b string, n int")
    joined = left.join(right, collated("a") == collated("b"))
    assert sorted(r["a"] for r in joined.collect()) == ["Bronx", "bronx "]
    assert left.select(collated("a").alias("a")).distinct().where(F.col("a").isNotNull()).count() == 1
