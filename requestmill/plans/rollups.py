"""Reports kept up to date by parts.

Each partition of a master has parts: counts, sums, minima and maxima of its rows, and counts of their
agencies and complaint types. A merge replaces partitions, so a refresh computes the parts of those
that were replaced and puts them in the place of the old ones, which takes off what moved or went. A
report folds parts and reads no row of the master. Keys are counted exactly, as a master has one
row of each.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from requestmill.functions import numeric, temporal, text
from requestmill.operators import reports
from requestmill.operators.reports import COMPLETENESS, DIGITS
from requestmill.schemas import KEY
from requestmill.sources import files
from requestmill.sources.master import PART, Master

FOLD_AT = 50  # folders of parts
VALUES = ("agency", "complaint_type")
NONBLANK = ("agency", "complaint_type")


@dataclass(frozen=True)
class Bands:
    """What the parts count by; another choice needs another rollup."""

    high: int = 80
    medium: int = 50
    closed: str = "Closed"


def _measures(bands: Bands) -> dict[str, Column]:
    """Additive measures of a partition's rows, and the extremes."""
    score, hours = F.col("data_quality_score"), F.col("resolution_hours")
    positive = F.when(hours > 0, hours)
    filled = {
        f"filled_{c}": F.count_if(text.is_filled(F.col(c)) if c in NONBLANK else F.col(c).isNotNull())
        for c in COMPLETENESS
    }
    return {
        "n": F.count("*"),
        **filled,
        "n_positive": F.count(positive),
        # sums of decimals do not depend on the order
        "sum_positive": F.sum(positive.cast("decimal(38,12)")),
        "n_score": F.count(score),
        "sum_score": F.sum(score.cast("decimal(38,6)")),
        "min_score": F.min(score),
        "max_score": F.max(score),
        "n_high": F.count_if(score >= bands.high),
        "n_medium": F.count_if(score.between(bands.medium, bands.high - 1)),
        "n_low": F.count_if(score < bands.medium),
        "n_closed_status": F.count_if(text.equals_ignoring_case(F.col("status"), bands.closed)),
        "first_created": F.min("created_date"),
        "last_created": F.max("created_date"),
        "last_processed": F.max("processed_at"),
    }


def _folded(name: str) -> Column:
    """How parts of one measure become the whole's; an empty master has counts of 0."""
    if name.startswith(("min_", "first_")):
        return F.min(name)
    if name.startswith(("max_", "last_")):
        return F.max(name)
    total = F.sum(name)
    return total if name.startswith("sum_") else F.coalesce(total, F.lit(0).cast("long"))


class Rollup:
    """Parts of a master's partitions in ``root``: two tables, and a pointer like the master's.

    The pointer says for each partition which folder of the master its parts are of, and which of our
    folders holds them. A refresh that dies on the way changes nothing. One refresh at a time.
    """

    def __init__(self, master: Master, root: str, bands: Bands = Bands()):
        self.spark: SparkSession = master.spark
        self.master, self.root, self.bands = master, root.rstrip("/"), bands

    def _pointer(self) -> dict:
        found = files.read_document(self.spark, f"{self.root}/current.json")
        wanted = [self.bands.high, self.bands.medium, self.bands.closed]
        if found is None:
            return {"bands": wanted, "parts": {}}
        if found["bands"] != wanted:
            raise ValueError(f"{self.root} counts by {found['bands']}, not by {wanted}")
        return found

    def refresh(self) -> list[str]:
        """Compute the parts of replaced and new partitions, drop those of lost ones; names of the first.

        Only these partitions' rows are read. With nothing to do nothing is written.
        """
        before = self._pointer()
        current = self.master.pointer()["partitions"]
        had = before["parts"]
        stale = {p: v for p, v in current.items() if had.get(p, {}).get("of") != v}
        if not stale and had.keys() == current.keys():
            return []
        kept = {p: had[p] for p in current if p not in stale}
        folder = f"parts-{uuid.uuid4().hex[:12]}"
        if stale:
            self._write(self.master.rows_of(stale), folder)
        parts = {**kept, **{p: {"of": v, "in": folder} for p, v in stale.items()}}
        files.write_document(self.spark, f"{self.root}/current.json", {**before, "parts": parts})
        if len({x["in"] for x in parts.values()}) >= FOLD_AT:
            self._fold(parts, before)
        return sorted(stale)

    def _write(self, rows: DataFrame, folder: str) -> None:
        measured = rows.groupBy(PART).agg(*(c.alias(n) for n, c in _measures(self.bands).items()))
        measured.write.parquet(f"{self.root}/{folder}/measures")
        each = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in VALUES)))
        counted = rows.select(PART, each.alias("v")).groupBy(PART, "v.kind", "v.value")
        counted.agg(F.count("*").alias("n")).write.parquet(f"{self.root}/{folder}/values")

    def _fold(self, parts: dict, before: dict) -> None:
        """All current parts in one folder; older folders go at the next fold."""
        folder = f"parts-{uuid.uuid4().hex[:12]}"
        for name in ("measures", "values"):
            self._read(name, parts).write.parquet(f"{self.root}/{folder}/{name}")
        moved = {p: {**x, "in": folder} for p, x in parts.items()}
        old = before.get("old", [])
        left = sorted({x["in"] for x in parts.values()})
        document = {**before, "parts": moved, "old": left}
        files.write_document(self.spark, f"{self.root}/current.json", document)
        for name in old:  # readers of the state before this one may still be there
            files.delete_folder(self.spark, f"{self.root}/{name}")

    def _read(self, name: str, parts: dict) -> DataFrame:
        """Current parts; folders also hold some that were replaced later."""
        folders = sorted({x["in"] for x in parts.values()})
        paths = [f"{self.root}/{f}/{name}" for f in folders]
        rows = self.spark.read.parquet(*paths)
        place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
        named = self.spark.createDataFrame(
            [(p, x["in"]) for p, x in parts.items()], "__part string, __folder string"
        )
        # one row for each partition of the master, as its own pointer has
        same = (rows[PART] == named["__part"]) & (F.col("__place") == named["__folder"])
        return rows.withColumn("__place", place).join(named, same, "left_semi").select(*rows.columns)

    def measures(self) -> DataFrame:
        """A row for each partition."""
        return self._table("measures")

    def values(self) -> DataFrame:
        """(part, kind, value, n): how often a partition has each agency and complaint type."""
        return self._table("values")

    def _table(self, name: str) -> DataFrame:
        parts = self._pointer()["parts"]
        if parts:
            return self._read(name, parts)
        empty = self.master.rows_of({})
        if name == "values":
            return self.spark.createDataFrame([], f"{PART} string, kind string, value string, n long")
        return empty.groupBy(PART).agg(*(c.alias(n) for n, c in _measures(self.bands).items()))

    # Newest rows ----------------------------------------------------------------

    def newest_parts(self, n: int, column: str = "created_date", key: str = KEY) -> dict[str, str]:
        """Partitions that hold the newest ``n`` rows by a column, ties by key, and their folders.

        Partitions are taken from the one with the newest row on until they have n rows; the n-th of these
        is a bound, and only partitions whose newest row reaches it can change the result.
        """
        newest = {"created_date": "last_created", "processed_at": "last_processed"}[column]
        parts = self._pointer()["parts"]
        if not parts:
            return {}
        # a row for each partition, as the pointer has
        rows = self.measures().select(PART, "n", newest).orderBy(F.desc_nulls_last(newest), PART).collect()
        chosen, count = [], 0
        for r in rows:
            if count >= n:
                break
            chosen.append(r[PART])
            count += r["n"]
        first = self.master.rows_of({p: parts[p]["of"] for p in chosen})
        top = first.orderBy(F.desc(column), F.asc(key)).limit(n).select(column).collect()
        bound = top[-1][column] if len(top) == n else None
        if bound is None:  # rows without a value are among them
            return {p: x["of"] for p, x in parts.items()}
        return {r[PART]: parts[r[PART]]["of"] for r in rows if r[newest] is not None and r[newest] >= bound}

    def _newest(self, n: int, column: str) -> DataFrame:
        return self.master.rows_of(self.newest_parts(n, column)).drop(PART)

    def latest_created(self, n: int = 10) -> DataFrame:
        return reports.latest_created(self._newest(n, "created_date"), n)

    def latest_processed(self, n: int = 5) -> DataFrame:
        return reports.latest_processed(self._newest(n, "processed_at"), n)

    # Reports ------------------------------------------------------------------

    def whole(self) -> DataFrame:
        """All measures of the whole master in one row."""
        return self.measures().agg(*(_folded(n).alias(n) for n in _measures(self.bands)))

    def _report(self, **columns: Column | str) -> DataFrame:
        chosen = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
        return self.whole().select(*chosen)

    @staticmethod
    def _average(total: str, count: str, digits: int = DIGITS) -> Column:
        whole = F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0)).cast("double")
        return F.round(whole, digits)

    def total_rows(self) -> DataFrame:
        return self._report(total_rows="n")

    def overall_stats(self, digits: int = 2) -> DataFrame:
        return self._report(
            total_rows="n",
            unique_records=f"filled_{KEY}",
            rows_with_closed_date="filled_closed_date",
            rows_with_resolution_hours="n_positive",
            avg_resolution_hours=self._average("sum_positive", "n_positive", digits),
            latest_record="last_created",
            last_processed="last_processed",
        )

    def completeness(self, columns: Sequence[str] = COMPLETENESS) -> DataFrame:
        counts = self._report(total="n", **{f"{c}_filled": f"filled_{c}" for c in columns})
        return counts.withColumns(
            {f"{c}_pct": numeric.percent_of(F.col(f"{c}_filled"), F.col("total")) for c in columns}
        )

    def quality_bands(self) -> DataFrame:
        return self._report(
            avg_quality=self._average("sum_score", "n_score"),
            min_quality="min_score",
            max_quality="max_score",
            high_quality_count="n_high",
            medium_quality_count="n_medium",
            low_quality_count="n_low",
        )

    def top_agencies(self, n: int = 5) -> DataFrame:
        counts = self.values().where("kind = 'agency'").groupBy(F.col("value").alias("agency"))
        found = counts.agg(F.sum("n").alias("request_count"))
        return found.orderBy(F.desc("request_count"), F.asc("agency")).limit(n)

    def date_range(self) -> DataFrame:
        return self._report(earliest="first_created", latest="last_created")

    def data_summary(self) -> DataFrame:
        kinds = {"agencies": "agency", "complaint_types": "complaint_type"}
        different = self.values().where("value IS NOT NULL").select("kind", "value").distinct()
        counts = different.agg(
            *(F.count_if(F.col("kind") == kind).alias(name) for name, kind in kinds.items())
        )
        both = self.whole().unionByName(counts, allowMissingColumns=True)  # one row each
        whole = both.agg(*(F.max(c).alias(c) for c in ("n", *kinds, "first_created", "last_created")))
        return whole.select(
            F.col("n").alias("total_records"),
            *kinds,
            F.col("first_created").alias("earliest_date"),
            F.col("last_created").alias("latest_date"),
        )

    def quality_summary(self) -> DataFrame:
        return self._report(
            total_records="n",
            avg_quality=self._average("sum_score", "n_score"),
            earliest_record="first_created",
            latest_record="last_created",
        )

    def closed_summary(self) -> DataFrame:
        return self._report(
            total_records="n",
            avg_quality_score=self._average("sum_score", "n_score"),
            closed_count="n_closed_status",
        )

    def column_stats(self) -> DataFrame:
        return self._report(
            closed_date_count="filled_closed_date",
            resolution_hours_count="filled_resolution_hours",
            avg_quality=self._average("sum_score", "n_score"),
        )

    def run_check(self) -> DataFrame:
        return self._report(
            total_rows="n",
            rows_with_closed_date="filled_closed_date",
            rows_with_resolution_hours="filled_resolution_hours",
            avg_resolution_hours=self._average("sum_positive", "n_positive"),
            latest_record="last_created",
            last_processed="last_processed",
        )

    def average_quality(self) -> DataFrame:
        return self._report(avg_quality=self._average("sum_score", "n_score"))

    def high_water_mark(self) -> DataFrame:
        return self._report(last_processed_time=temporal.to_iso_seconds(F.col("last_created")))
