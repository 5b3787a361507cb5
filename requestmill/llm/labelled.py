"""Labelled documents to fit a classifier on: all of them, or a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestmill.llm.common import written

SLOTS = (1 << 26) - 1  # of ids, with a bit in each of two bitmaps: 16 MB at most


@dataclass(frozen=True)
class Split:
    """Rows whose crc32 of the id's text has this remainder are held out, never learned from."""

    modulus: int
    held_out: int

    def column(self, doc_id: Column) -> Column:
        text = F.coalesce(doc_id.cast("string"), F.lit(""))
        return F.crc32(text.cast("binary")) % self.modulus == self.held_out


@dataclass(frozen=True)
class Sample:
    """Documents with ``text`` and label ``y``, and how many labelled documents there are of each kind."""

    rows: DataFrame
    positives: int
    negatives: int


def _known(
    docs: DataFrame, labels: DataFrame, label: str, split: Split
) -> tuple[DataFrame, dict[int, int]]:
    """(__llm_id, y) of the labels that may be learned from, and how many there are of each kind."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(~split.column(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("__llm_id"))
        .agg(F.max(label).cast("int").alias("y"))
    )
    # only ids are shuffled for this
    there = docs.select(F.col("doc_id").cast("long").alias("__llm_id")).where("__llm_id IS NOT NULL")
    known = known.join(there, "__llm_id", "left_semi")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    return known, sizes


def _one_of_each(rows: DataFrame) -> DataFrame:
    """One document of each id, the one with the smallest text."""
    one = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    return rows.withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")


def _places(ids: Column, slots: int) -> dict[str, Column]:
    """Where an id's bits are: the bitmap, and the bit in it."""
    slot = F.pmod(ids, F.lit(slots))
    return {"__llm_map": F.bitmap_bucket_number(slot), "__llm_at": F.bitmap_bit_position(slot).cast("int")}


def _slots(ids: DataFrame, known: DataFrame, slots: int) -> DataFrame:
    """Bitmaps of the slots with a label: one that a single row has is in ``y1`` or ``y0``, by its label; one
    that several rows share is in both. ``rows`` is the greatest number of rows in a slot."""
    rows = ids.select("doc_id", F.lit(1).alias("n"), F.lit(None).cast("int").alias("y"))
    rows = rows.union(known.select("__llm_id", F.lit(0), "y")).withColumns(_places(F.col("doc_id"), slots))
    each = rows.groupBy("__llm_map", "__llm_at").agg(F.sum("n").alias("n"), F.max("y").alias("y"))

    def bits(label: int) -> Column:
        return F.bitmap_construct_agg(F.when((F.col("n") > 1) | (F.col("y") == label), F.col("__llm_at")))

    return (
        each.where("y IS NOT NULL")
        .groupBy("__llm_map")
        .agg(bits(1).alias("y1"), bits(0).alias("y0"), F.max("n").alias("rows"))
    )


def _is_set(bits: str) -> Column:
    byte = F.substring(bits, F.shiftright("__llm_at", 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.col("__llm_at").bitwiseAND(F.lit(7))) == 1


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, split: Split, most_slots: int = SLOTS
) -> Sample:
    """All documents with a label that is not held out.

    Labels given twice count once (the larger one); null labels and labels without a document teach
    nothing. Texts stay in the tasks that read them: each id has a slot, its remainder by the number of slots,
    some eight for each document and ``most_slots`` at most. Bitmaps of the slots, of a bounded size, bring the
    labels to the texts. Only rows that share a slot, so all rows of a repeated id, are shuffled and joined by id.
    """
    known, sizes = _known(docs, labels, label, split)
    known = written(known, f"{label}-labels")
    texts = docs.select(F.col("doc_id").cast("long"), "text").where(
        ~split.column(F.col("doc_id")) & F.col("doc_id").isNotNull()
    )
    slots = min(most_slots, 8 * docs.count() + 1)
    here = known.where(~split.column(F.col("__llm_id")))
    maps = written(_slots(texts.select("doc_id"), here, slots), f"{label}-slots")
    found = (
        texts.withColumns(_places(F.col("doc_id"), slots))
        .join(F.broadcast(maps.drop("rows")), "__llm_map")
        .withColumns({"y1": _is_set("y1"), "y0": _is_set("y0")})
    )
    rows = found.where("y1 <> y0").select("doc_id", "text", F.col("y1").cast("int").alias("y"))
    if (maps.agg(F.max("rows")).first()[0] or 0) > 1:
        # chosen first, so that a task hands on one row of an id at most, however often it is repeated
        shared = _one_of_each(found.where("y1 AND y0").select("doc_id", "text"))
        shared = shared.join(known, F.col("doc_id") == F.col("__llm_id"))
        rows = rows.unionByName(shared.select("doc_id", "text", "y"))
    return Sample(rows, sizes.get(1, 0), sizes.get(0, 0))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, split: Split, most_of_each: int
) -> Sample:
    """At most ``most_of_each`` documents of either label, chosen by a hash of the id.

    This bounds what a classifier is fitted on, nothing else. Labels given twice count once (the
    larger one); null labels and labels without a document teach nothing.
    """
    known, sizes = _known(docs, labels, label, split)
    order = F.xxhash64("__llm_id", F.lit(label))
    chosen = known.where("y = 1").orderBy(order, "__llm_id").limit(most_of_each)
    chosen = chosen.unionByName(
        known.where("y = 0").orderBy(order, "__llm_id").limit(most_of_each)
    )
    # 2 x most_of_each rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("__llm_id")
    )
    return Sample(
        _one_of_each(rows).select("doc_id", "text", "y"), sizes.get(1, 0), sizes.get(0, 0)
    )
