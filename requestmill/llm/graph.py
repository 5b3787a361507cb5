"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import written


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(
        both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(low.withColumnRenamed("m", "v")))


def _signature(edges: DataFrame) -> tuple:
    """Size and an order-free hash of the edge set."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("v", "u")),
        ).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    ``edges`` has the columns u and v of one orderable type. Each round attaches
    neighbours to the smallest node they know; a chain of n nodes takes about log n
    rounds. Every round is written to the shared folder. Minima are pre-aggregated and
    hubs are joined, not collected, so a node of any degree is split over tasks.
    No edges: no rows.
    """
    now = written(_oriented(edges), "edges")
    before = None
    signature = _signature(now)
    while signature != before:
        before = signature
        now = written(_small_star(_large_star(now)), "stars")
        signature = _signature(now)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
