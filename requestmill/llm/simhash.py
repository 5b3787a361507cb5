"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in d bits have a common point at most half of d bits away from
either. So each distinct fingerprint emits all variants within half the radius, equal
variants meet in one shuffle, and those that meet are checked and linked. A group of one
variant holds the fingerprints of its ball only (65 for radius 2), however many
documents there are, and documents with one fingerprint take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestmill.llm.common import sliced, written
from requestmill.llm.graph import connected_components

SEED = 42


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """64-bit SimHash of UTF-8 bytes as an unsigned number; no word gives zero."""
    words = text.lower().split() if text else []  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    count = max(1, len(words) - width + 1)
    hashed = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, count)
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > count
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _hash_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            prints = np.array(
                [fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)],
                ["doc_id", "fp", "text_hash"],
            )

    return run


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp, text_hash), one row for each row; fp is the 64-bit pattern as a signed long."""
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("binary").alias("text"),
        F.xxhash64("text").alias("text_hash"),
    )
    return rows.mapInArrow(_hash_batches(width), "doc_id long, fp long, text_hash long")


def _ball(radius: int) -> list[int]:
    """Masks with at most ``radius`` bits set, as signed longs."""
    masks = [
        sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)
    ]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(prints: DataFrame, radius: int) -> DataFrame:
    masks = F.explode(F.array(*(F.lit(m).cast("long") for m in _ball(radius))))
    return prints.select("fp", masks.alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all pairs within ``max_bits``.

    All members of one ball of radius r differ in 2r bits at most, so for an even distance
    each member is linked to the one before it. For an odd distance the balls
    of the rounded-down and the rounded-up half meet. The distance is checked in either case.
    """
    low, high = max_bits // 2, (max_bits + 1) // 2
    if low == high:
        order = Window.partitionBy("variant").orderBy("fp")
        pairs = _variants(prints, low).select("fp", F.lag("fp").over(order).alias("other"))
        pairs = pairs.where("other IS NOT NULL")
    else:
        wide = _variants(prints, high).withColumnRenamed("fp", "other")
        pairs = _variants(prints, low).join(wide, "variant").where("fp < other")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    return pairs.where(close).select(F.col("fp").alias("u"), F.col("other").alias("v")).distinct()


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of each fingerprint that occurs."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return written(rooted.join(smallest, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    component_id is the smallest doc_id that a chain of links reaches, its own included.
    Null, empty and blank texts have fingerprint zero and are linked like any other. Rows
    given twice give two rows. A null doc_id is smallest only where there is no other. An
    empty table gives no rows; other columns are not read.
    """
    prints = written(fingerprints(docs, width).drop("text_hash"), "fingerprints")
    return prints.join(_classes(prints, max_bits).drop("root"), "fp", "left")


def one_of_each(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component, with its own columns: the first by doc_id (null last), then text.

    Rows are judged by their own text, so an id that is given twice with texts of two components may
    stay in both, and rows without an id are like others. Of rows that share id and text one stays.
    """
    prints = written(fingerprints(docs, width), "fingerprints")
    classes = _classes(prints, max_bits)
    first = prints.join(classes, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.withColumns(_row_key(F.col("doc_id"), F.col("text_hash")))
    first = written(first.select("root", *ROW_KEY).distinct(), "first-rows")
    keyed = docs.withColumns(_row_key(F.col("doc_id").cast("long"), F.xxhash64("text")))
    tied = first.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    if not tied.isEmpty():  # an id with several texts of one component: the texts are compared
        among = first.join(tied, "root")
        order = Window.partitionBy("root").orderBy(F.col("text").asc_nulls_last())
        best = (
            keyed.select(*ROW_KEY, "text")
            .join(among, ROW_KEY)
            .withColumn("n", F.row_number().over(order))
            .where("n = 1")
            .select("root", *ROW_KEY)
        )
        first = first.join(tied, "root", "left_anti").unionByName(written(best, "tied-rows"))
    # copies of a row go below the exchange, one for each task stays
    kinds = ("map", "array", "struct", "variant")
    plain = [F.col(c) for c, kind in docs.dtypes if not kind.startswith(kinds) and c != "text"]
    copies = Window.partitionBy(*ROW_KEY).orderBy(F.lit(0), *plain)
    single = keyed.withColumn("__llm_n", F.row_number().over(copies)).where("__llm_n = 1")
    # the same keys again: texts are shuffled once
    return single.join(first.select(*ROW_KEY), ROW_KEY, "left_semi").select(*docs.columns)


ROW_KEY = ["__llm_id", "__llm_none", "__llm_hash"]


def _row_key(doc_id: Column, text_hash: Column) -> dict[str, Column]:
    """What tells rows apart, without nulls."""
    values = (F.coalesce(doc_id, F.lit(0).cast("long")), doc_id.isNull(), text_hash)
    return dict(zip(ROW_KEY, values, strict=True))
