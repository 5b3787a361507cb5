"""What several operators need: tables, written intermediate results, expressions."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from requestmill.session import working_folder

ROW = "__llm_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and a lost
    executor costs no more than its own tasks."""
    path = working_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times, inside lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def window_hashes(words: Column, width: int) -> Column:
    """64-bit hash of each run of ``width`` words, for arrays of at least so many words.

    Runs are put together from halves, so a run costs a few hashes of numbers.
    """

    def of(hashes: Column, k: int) -> Column:
        count = F.size(hashes) - (k - 1)

        def joined(a: Column, b: Column, shift: int) -> Column:
            return F.zip_with(
                F.slice(a, 1, count), F.slice(b, 1 + shift, count), lambda x, y: F.xxhash64(x, y)
            )

        if k == 1:
            return hashes
        if k % 2:
            return joined(of(hashes, k - 1), hashes, k - 1)
        return let(of(hashes, k // 2), lambda half: joined(half, half, k // 2))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: of(h, width))


def sliced(batches: Iterator, rows: int = 512) -> Iterator:
    """The same rows in smaller batches, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker does."""
    return sys.__dict__.setdefault("_requestmill_llm", {})
