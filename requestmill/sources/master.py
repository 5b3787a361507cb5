"""A master dataset: the current row of every key, replaced piece by piece.

Rows lie in partitions, either by creation time or by key bucket. A merge rewrites
the partitions it touches into a new folder and then replaces one small pointer
file that names the folder of every partition. Readers see the old or the new
state and never a mixture, and a run that dies on the way changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill.operators import dedup
from requestmill.schemas import KEY
from requestmill.session import session_conf
from requestmill.sources import files
from requestmill.sources.landing import OWN_CSV, escape_breaks, restore_breaks
from requestmill.sources.tables import MILLISECOND_FILES
from requestmill.functions.temporal import parse_timestamp

PART = "part"
BATCH = "batch_id"

# Keys of an increment are sent to all executors up to this size, which is measured.
BROADCAST_BYTES = 64 * 1024 * 1024
# Seconds after which a claim to commit counts as left by a dead writer.
CLAIM_EXPIRY = 600.0
# Keys of an increment up to this number are looked up one by one, beyond it by their range.
LISTED_KEYS = 500
# Rough cost of one row in a broadcast relation besides its key.
ROW_OVERHEAD = 50

_TIME_UNITS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM"}
NO_TIME = "none"


@dataclass(frozen=True)
class Layout:
    """How rows are spread over partitions.

    ``time``: by creation hour, day or month. Increments of recent requests then
    rewrite recent partitions only. A changed creation time may move a row, so the
    merge looks its key up in the other partitions; say ``rows_move=False`` for a
    source that never changes it. ``buckets``: by key. A key never moves, at the
    price that a large increment touches every bucket.
    """

    kind: str = "time"
    unit: str = "day"
    column: str = "created_date"
    rows_move: bool = True
    buckets: int = 64

    def __post_init__(self) -> None:
        if self.kind not in ("time", "buckets") or self.unit not in _TIME_UNITS:
            raise ValueError(f"unknown layout {self.kind} by {self.unit}")

    @property
    def keys_stay(self) -> bool:
        return self.kind == "buckets" or not self.rows_move

    def partition_of(self, df: DataFrame, key: str) -> Column:
        if self.kind == "buckets":
            return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("string")
        moment = F.col(self.column)
        if isinstance(df.schema[self.column].dataType, T.StringType):
            moment = parse_timestamp(moment)
        return F.coalesce(F.date_format(moment, _TIME_UNITS[self.unit]), F.lit(NO_TIME))


@dataclass(frozen=True)
class Keys:
    """Measured facts about the keys of an increment."""

    rows: int
    broadcast_size: int
    lowest: str | None
    highest: str | None
    any_null: bool
    repeated: bool = False
    parts: frozenset[str] = frozenset()

    def within(self, key: str) -> Column:
        """A condition every one of these keys meets; it is pushed to the scan."""
        inside = F.lit(False)
        if self.lowest is not None:
            inside = F.col(key).between(self.lowest, self.highest)
        return inside | F.col(key).isNull() if self.any_null else inside


@dataclass(frozen=True)
class MergeResult:
    version: int
    path: str
    partitions_written: int
    strategy: str


class Master:
    """One master dataset below ``root``.

    Writers do not disturb each other: each attempt writes to a folder of its own, and of
    two that began with the same version the first to commit wins and the other raises.
    The layout is stored with the data, and opening it with another one raises.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        layout: Layout = Layout(),
        fmt: str = "parquet",
        key: str = KEY,
        broadcast_bytes: int = BROADCAST_BYTES,
        milliseconds: bool = False,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout
        self.fmt = fmt
        self.key = key
        self.broadcast_bytes = broadcast_bytes
        self.milliseconds = milliseconds
        self.columns = list(schema.names)
        self.stored = T.StructType(
            list(schema.fields)
            + [T.StructField(BATCH, T.LongType()), T.StructField(PART, T.StringType())]
        )

    @property
    def _pointer_path(self) -> str:
        return f"{self.root}/current.json"

    @property
    def _data_path(self) -> str:
        return f"{self.root}/data"

    def pointer(self) -> dict:
        """Version and folder of each partition; empty before the first merge."""
        found = files.read_document(self.spark, self._pointer_path)
        if found is None:
            return {"version": 0, "partitions": {}}
        stored = found.get("layout", self._layout)
        if stored != self._layout:
            raise ValueError(f"{self.root} is laid out as {stored}, not as {self._layout}")
        return found

    @property
    def _layout(self) -> dict:
        """What must not change over the life of the dataset."""
        place = (
            {"buckets": self.layout.buckets}
            if self.layout.kind == "buckets"
            else {"unit": self.layout.unit, "column": self.layout.column}
        )
        return {"kind": self.layout.kind, **place, "format": self.fmt, "key": self.key}

    def _read_partitions(self, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        reader = self.spark.read.schema(self.stored).option("basePath", self._data_path)
        if self.fmt == "csv":
            reader = reader.options(**OWN_CSV)
        paths = [f"{self._data_path}/{v}/{PART}={p}" for p, v in sorted(folders.items())]
        rows = reader.format(self.fmt).load(paths).select(*self.stored.names)
        return restore_breaks(rows, self.columns) if self.fmt == "csv" else rows

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """The current rows; empty with the full schema before the first merge.

        ``start`` and ``end`` (days as ``YYYY-MM-DD``, ``end`` left out) restrict a
        time layout to creation times between them, and the scan to their folders.
        """
        folders = self.pointer()["partitions"]
        if start is None and end is None:
            return self._read_partitions(folders).select(*self.columns)
        if self.layout.kind != "time":
            raise ValueError("only a time layout can be read by time")
        width = len(_TIME_UNITS[self.layout.unit])
        chosen = {
            p: v
            for p, v in folders.items()
            if p != NO_TIME
            and (start is None or p >= start[:width])
            and (end is None or p < end)
        }
        rows = self._read_partitions(chosen).select(*self.columns)
        moment = F.col(self.layout.column)
        if start is not None:
            rows = rows.where(moment >= F.lit(start).cast("timestamp"))
        if end is not None:
            rows = rows.where(moment < F.lit(end).cast("timestamp"))
        return rows

    def rows_of(self, folders: dict[str, str]) -> DataFrame:
        """Rows of given partitions in given folders, with the partition's name."""
        return self._read_partitions(folders).select(*self.columns, PART)

    def _measure(self, new: DataFrame) -> Keys:
        """Keys and partitions of the increment, in one job that reads these two columns."""
        key = F.col(self.key)
        row = new.agg(
            F.count("*"), F.coalesce(F.sum(F.octet_length(key)), F.lit(0)),
            F.min(key), F.max(key), F.count_if(key.isNull()), F.count_distinct(key),
            F.collect_set(PART),
        ).first()
        repeated = row[0] > row[5] + min(row[4], 1)
        size = row[1] + ROW_OVERHEAD * row[0]
        return Keys(row[0], size, row[2], row[3], row[4] > 0, repeated, frozenset(row[6]))

    def _names(self, df: DataFrame) -> set[str]:
        """Partition names in a relation: as many as there are time units or buckets."""
        return {row[0] for row in df.select(PART).distinct().toLocalIterator()}

    def _touched(
        self, new: DataFrame, folders: dict[str, str], keys: Keys, small: bool
    ) -> set[str]:
        """Partitions that get new rows or hold a row the increment replaces.

        The lookup reads the key column of the other partitions, and of those only
        the row groups that can hold one of the keys: files are sorted by key and carry a
        bloom filter of it.
        """
        touched = set(keys.parts)
        others = {p: v for p, v in folders.items() if p not in touched}
        if self.layout.keys_stay or not others:
            return touched
        wanted = new.select(F.col(self.key).alias("_new_key")).distinct()
        possible = keys.within(self.key)
        if keys.rows <= LISTED_KEYS:
            listed = [r[0] for r in wanted.where("_new_key IS NOT NULL").collect()]
            possible = possible & (F.col(self.key).isin(listed) | F.col(self.key).isNull())
        if small:
            wanted = F.broadcast(wanted)
        holding = (
            self._read_partitions(others)
            .where(possible)
            .join(wanted, F.col(self.key).eqNullSafe(F.col("_new_key")), "left_semi")
        )
        return touched | self._names(holding)

    def _as_stored(self, increment: DataFrame, version: int) -> DataFrame:
        """The increment with all stored columns; columns it lacks are NULL."""
        absent = {
            f.name: F.lit(None).cast(f.dataType)
            for f in self.stored
            if f.name not in (*increment.columns, BATCH, PART)
        }
        rows = increment.withColumns({**absent, BATCH: F.lit(version).cast("bigint")})
        return rows.withColumn(PART, self.layout.partition_of(rows, self.key))

    def merge(self, increment: DataFrame, order: Sequence[str] | None = None) -> MergeResult:
        """Put an increment in, the last row of each key winning.

        ``order`` sorts the increment's rows of one key. Without it, or between rows that are
        equal in it, the row that is last by all its columns wins, so the result never depends on
        sizes or on the order of reading. The increment is read more than once, so it
        should be a written dataset. Merging it twice gives the same rows.
        """
        before = self.pointer()
        version = before["version"] + 1
        folders = before["partitions"]

        new = self._as_stored(increment, version)
        keys = self._measure(new)
        small = keys.broadcast_size <= self.broadcast_bytes
        touched = self._touched(new, folders, keys, small) if folders else set()
        old = self._read_partitions({p: v for p, v in folders.items() if p in touched})
        if keys.repeated:
            ties = [c for c in new.columns if c not in (self.key, *(order or ()))]
            new = dedup.dedup_last(new, (*(order or ()), *ties), self.key)
        if folders and not small:
            strategy = "union"
            merged = dedup.merge_keep_last(old, new, (BATCH,), self.key)
        else:
            strategy = "anti_join" if folders else "first"
            merged = new
            if folders:
                kept_rows = dedup.without_keys(old, new, self.key, broadcast=True)
                merged = dedup.union_by_name(kept_rows, merged)

        self._still(before["version"])
        folder = f"v={version}-{uuid.uuid4().hex[:12]}"
        path = f"{self._data_path}/{folder}"
        self._write(merged.select(*self.stored.names), path)
        written = [
            name.split("=", 1)[1]
            for name in files.child_names(self.spark, path)
            if name.startswith(f"{PART}=")
        ]
        untouched = {p: v for p, v in folders.items() if p not in touched}
        self._commit(version, {**untouched, **{p: folder for p in written}})
        return MergeResult(version, path, len(written), strategy)

    def _still(self, version: int) -> None:
        if self.pointer()["version"] != version:
            raise RuntimeError(f"{self.root} was changed by another writer")

    def _commit(self, version: int, partitions: dict[str, str]) -> None:
        """Replace the pointer, as the only one that may do so for this version."""
        claim = f"{self.root}/claims/{version}"
        if not files.claim(self.spark, claim, CLAIM_EXPIRY):
            raise RuntimeError(f"{self.root} is being changed by another writer")
        try:
            self._still(version - 1)
            files.write_document(
                self.spark,
                self._pointer_path,
                {"version": version, "layout": self._layout, "partitions": partitions},
            )
        finally:
            files.delete_folder(self.spark, claim)

    def _write(self, merged: DataFrame, path: str) -> None:
        """Write by partition, sorted by key. The rebalance joins small pieces and splits
        large ones."""
        rows = merged.hint("rebalance", PART).sortWithinPartitions(PART, self.key)
        if self.fmt == "csv":
            rows = escape_breaks(rows, self.columns)
        writer = rows.write.partitionBy(PART).mode("errorifexists")
        if self.fmt == "csv":
            writer = writer.options(**OWN_CSV)
        else:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        with session_conf(self.spark, MILLISECOND_FILES if self.milliseconds else {}):
            writer.format(self.fmt).save(path)

    def vacuum(self, grace: float = 3600.0) -> int:
        """Delete partition folders that the current version does not name.

        What was changed within the last ``grace`` seconds stays: it may be an attempt
        under way, or be read by someone who opened the version before.
        """
        used = self.pointer()["partitions"]
        deleted = 0
        for version in files.child_names(self.spark, self._data_path):
            if not version.startswith("v="):
                continue
            path = f"{self._data_path}/{version}"
            names = files.child_names(self.spark, path)
            if "_temporary" in names:  # an attempt under way, however old
                continue
            parts = [n for n in names if n.startswith(f"{PART}=")]
            current = {p for p in parts if used.get(p.split("=", 1)[1]) == version}
            stale = [
                f"{path}/{p}"
                for p in parts
                if p not in current and files.age_seconds(self.spark, f"{path}/{p}") >= grace
            ]
            for name in stale:
                files.delete_folder(self.spark, name)
            deleted += len(stale)
            if len(stale) == len(parts) and files.age_seconds(self.spark, path) >= grace:
                files.delete_folder(self.spark, path)
        return deleted
