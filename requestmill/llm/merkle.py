"""Merkle manifest with incremental witnesses.

Nodes are appended in order. A complete subtree stays open until its right sibling is complete, too;
then the roots of both are attached to the witnesses of all leaves below the other one. Spark deals
each tree out in aligned blocks, a task appends the nodes of one block after the other, and
the roots of blocks are appended in the same way one level higher, until each tree has one root.
A leaf's whole witness is its own, that of its block, that of its block's block and so on.

The node above two is the SHA-256 of both digests as hexadecimal text; a last node without a
sibling is hashed alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill.llm.common import sliced, written

BITS = 12  # a block has 2**BITS nodes at most
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEFT, RIGHT, ALONE = "<", ">", "."  # where a level's sibling stands


def above(*nodes: bytes) -> bytes:
    """The digest of a run of nodes, as 32 bytes."""
    return sha256("".join(n.hex() for n in nodes).encode()).digest()


class Appender:
    """One aligned block of nodes: appended one by one, each with its witness so far."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self.siblings = np.zeros((1 << bits, bits, 32), np.uint8)
        self.sides = np.full((1 << bits, bits), ord(ALONE), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.count = 0
        self.open: list[tuple[int, bytes]] = []  # (height, root) of complete subtrees, falling
        self.sides[:] = ord(ALONE)

    def _attach(self, height: int, start: int, middle: int, left: bytes, right: bytes) -> None:
        """Two siblings: what lies below the left one gets the right one's root and the other way."""
        self.siblings[start:middle, height] = np.frombuffer(right, np.uint8)
        self.sides[start:middle, height] = ord(RIGHT)
        self.siblings[middle : self.count, height] = np.frombuffer(left, np.uint8)
        self.sides[middle : self.count, height] = ord(LEFT)

    def append(self, node: bytes) -> None:
        self.count += 1
        height = 0
        while self.open and self.open[-1][0] == height:
            left = self.open.pop()[1]
            middle = self.count - (1 << height)
            self._attach(height, middle - (1 << height), middle, left, node)
            node = above(left, node)
            height += 1
        self.open.append((height, node))

    def close(self, whole_tree: bool) -> tuple[bytes, int]:
        """(root, levels). Unless the block is the whole tree it goes up all levels of a block."""
        levels = (self.count - 1).bit_length() if whole_tree else self.bits
        height, node = self.open.pop()
        while height < levels:
            if self.open and self.open[-1][0] == height:
                left = self.open.pop()[1]
                middle = self.count - 1 >> height << height
                self._attach(height, middle - (1 << height), middle, left, node)
                node = above(left, node)
            else:
                node = above(node)  # a run of one
            height += 1
        return node, levels

    def witness(self, k: int, levels: int) -> tuple[bytes, bytes]:
        """(siblings from below, sides) of the k-th node."""
        there = self.sides[k, :levels] != ord(ALONE)
        return self.siblings[k, :levels][there].tobytes(), self.sides[k, :levels].tobytes()


def _witness_batches(bits: int):
    """Rows sorted by tree and place, with ``siblings``, ``sides`` and the block's root ``top``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now, whole = Appender(bits), None, False
        held: list[pa.RecordBatch] = []  # the rows of the open block

        def closed() -> Iterator[pa.RecordBatch]:
            root, levels = block.close(whole)
            k = 0
            for part in held:
                found = [block.witness(i, levels) for i in range(k, k + part.num_rows)]
                k += part.num_rows
                columns = [
                    *part.columns,
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1].decode() for f in found], pa.string()),
                    pa.array([root] * part.num_rows, pa.binary()),
                ]
                names = [*part.schema.names, "siblings", "sides", "top"]
                yield pa.RecordBatch.from_arrays(columns, names)
            block.clear()
            held.clear()

        for batch in sliced(batches, 1 << bits):
            trees, places, sizes, nodes = (
                batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("tree", "at", "size", "node")
            )
            start = 0
            for k, (tree, at) in enumerate(zip(trees, places, strict=True)):
                if (tree, at >> bits) != now:
                    if k > start:
                        held.append(batch.slice(start, k - start))
                    if held:
                        yield from closed()
                    start, now, whole = k, (tree, at >> bits), sizes[k] <= 1 << bits
                block.append(nodes[k])
            if len(trees) > start:
                held.append(batch.slice(start))
        if held:
            yield from closed()

    return run


def ranked(rows: DataFrame, tree: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``at``, the place among the rows of one ``tree`` from 0, and ``size``, their number.

    Rows are sorted by ranges, so a tree with most rows lies in many tasks. Places inside a range
    and the sizes of ranges give the places in the tree; no task sees a whole tree.
    """
    ranges = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    place = F.monotonically_increasing_id()  # range and place in it
    placed = written(ranges.withColumn("__llm_place", place), f"{purpose}-places")
    placed = placed.withColumn("__llm_range", F.shiftright("__llm_place", 33))
    each = placed.groupBy(tree, "__llm_range").agg(
        F.count("*").alias("n"), F.min("__llm_place").alias("first")
    )
    # a row for each tree and range: at most as many as there are trees and ranges together
    ranges_before = Window.partitionBy(tree).orderBy("__llm_range")
    starts = each.select(
        F.col(tree).alias("__llm_tree"),
        F.col("__llm_range").alias("__llm_part"),
        "first",
        (F.sum("n").over(ranges_before) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy(tree)).alias("size"),
    )
    same = placed[tree].eqNullSafe(starts["__llm_tree"]) & (placed["__llm_range"] == starts["__llm_part"])
    found = placed.join(starts, same).withColumn("at", F.col("__llm_place") - F.col("first") + F.col("before"))
    return found.select(*rows.columns, "at", "size")


def _appended(nodes: DataFrame, bits: int, purpose: str) -> DataFrame:
    """One round of blocks. A block's rows go to one task, in order."""
    dealt = nodes.repartition("tree", F.shiftright("at", bits)).sortWithinPartitions("tree", "at")
    added = [
        T.StructField("siblings", T.BinaryType()),
        T.StructField("sides", T.StringType()),
        T.StructField("top", T.BinaryType()),
    ]
    schema = T.StructType([*dealt.schema.fields, *added])
    return written(dealt.mapInArrow(_witness_batches(bits), schema), purpose)


def witnesses(nodes: DataFrame, bits: int = BITS, purpose: str = "merkle") -> DataFrame:
    """``nodes`` (tree, at, size, node, further columns) with siblings, sides and root.

    ``siblings`` are the digests one after the other, from below; ``sides`` has a sign for each
    level: where the sibling stands, or that there is none. Each round divides the number of nodes by
    2**bits, so ten thousand million leaves take three.
    """
    found = _appended(nodes, bits, purpose)
    # a block's first node stands for the block, which is a node of the next round
    tops = found.where(F.col("at") % (1 << bits) == 0).where(F.col("size") > 1 << bits)
    tops = tops.select(
        "tree",
        F.shiftright("at", bits).alias("at"),
        F.ceil(F.col("size") / (1 << bits)).cast("long").alias("size"),
        F.col("top").alias("node"),
    )
    if tops.isEmpty():
        return found.withColumnRenamed("top", "root")
    higher = witnesses(tops, bits, f"{purpose}-up").select(
        F.col("tree").alias("__llm_tree"),
        F.col("at").alias("__llm_block"),
        F.col("siblings").alias("more"),
        F.col("sides").alias("more_sides"),
        F.col("root").alias("higher"),
    )
    same = F.col("tree").eqNullSafe(F.col("__llm_tree")) & (F.shiftright("at", bits) == F.col("__llm_block"))
    return found.join(higher, same, "left").select(
        *nodes.columns,
        F.concat("siblings", F.coalesce("more", F.lit(b""))).alias("siblings"),
        F.concat("sides", F.coalesce("more_sides", F.lit(""))).alias("sides"),
        F.coalesce("higher", "top").alias("root"),
    )


def folded(node: bytes, siblings: bytes, sides: str) -> bytes:
    """The root that a witness leads to from ``node``."""
    at = 0
    for side in sides:
        if side == ALONE:
            node = above(node)
            continue
        other = siblings[at : at + 32]
        at += 32
        node = above(other, node) if side == LEFT else above(node, other)
    return node


def leaf(fields: list[Column]) -> Column:
    """Hexadecimal SHA-256 of fields with their lengths in bytes, ``-`` for a null."""
    said = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in (f.cast("string") for f in fields)
    ]
    return F.sha2(F.concat(*said), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose id's decimal text has a crc32 that 7 divides; a null id has none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def _fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 2_048):
        out: list[tuple[str, str]] = []
        for node, siblings, sides in zip(*(c.to_pylist() for c in batch.columns[-3:]), strict=True):
            out.append((sha256(siblings.hex().encode()).hexdigest(), folded(node, siblings, sides).hex()))
        kept = batch.columns[:-3]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())],
            [*batch.schema.names[:-3], "proof_sha256", "folded_root"],
        )


def manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, lang, leaf, altered, siblings, sides, subroot, root), a row for each row of ``docs``.

    A leaf is made of doc_id, source, lang, n_chars and text; other columns are not read. Each lang, a
    null one included, is a tree with leaves by doc_id (nulls first), then leaf, so rows given twice are
    two leaves side by side with the same digest. The trees' roots, by lang with the null
    first, are the leaves of the last tree. ``altered`` is the leaf after tampering where there
    was some, else null. A lone leaf is its tree's root. No documents: no rows.
    """
    texts = {"source", "lang", "text"}
    columns = {c: F.col(c).cast("string" if c in texts else "long") for c in LEAF_FIELDS}
    rows = docs.select(*(c.alias(n) for n, c in columns.items()))
    fields = [F.col(c) for c in LEAF_FIELDS]
    changed = [F.try_add(c, F.lit(1)) if c == "n_chars" else F.col(c) for c in LEAF_FIELDS]
    leaves = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("lang").alias("tree"),
        "doc_id",
        F.unhex(leaf(fields)).alias("node"),
        F.when(tampered(F.col("doc_id")), F.unhex(leaf(changed))).alias("altered"),
    )
    leaves = written(leaves, "merkle-leaves")
    placed = ranked(leaves, "tree", ["doc_id", "node", "row"], "merkle").drop("row")
    below = witnesses(placed, bits)
    subroots = below.where("at = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("root").alias("node")
    )
    trees = ranked(written(subroots, "merkle-subroots"), "tree", ["lang"], "merkle-trees")
    top = witnesses(trees, bits, "merkle-top").select(
        F.col("lang").alias("__llm_lang"),
        F.col("siblings").alias("more"),
        F.col("sides").alias("more_sides"),
        F.col("root").alias("whole"),
    )
    return below.join(top, F.col("tree").eqNullSafe(F.col("__llm_lang"))).select(
        "doc_id",
        F.col("tree").alias("lang"),
        F.col("node").alias("leaf"),
        "altered",
        F.concat("siblings", "more").alias("siblings"),
        F.concat("sides", "more_sides").alias("sides"),
        F.col("root").alias("subroot"),
        F.col("whole").alias("root"),
    )


def checked(found: DataFrame) -> DataFrame:
    """A manifest's rows in hexadecimal, with each leaf folded up its witness: the altered
    one where there is one. ``verified`` says that this gives the root."""
    rows = found.select(
        "doc_id",
        *(F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.coalesce("altered", "leaf").alias("node"),
        "siblings",
        "sides",
    )
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return rows.mapInArrow(_fold_batches, schema).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
