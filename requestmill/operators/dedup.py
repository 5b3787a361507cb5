"""One row per key, and the merge of two relations.

Every function here keeps exactly one row per key, NULL being a key of its own.
The filter on ``row_number`` lets Spark keep the best row of each key and task
before the exchange, so a key that holds a third of all rows costs one row per
task, not one overloaded task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestmill.schemas import KEY

_RANK = "_rank_in_key"


def _best_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def dedup_first(df: DataFrame, order: Sequence[str] = ("seq",), key: str = KEY) -> DataFrame:
    """The first row of each key in the given order."""
    return _best_per_key(df, key, [F.col(c).asc() for c in order])


def dedup_last(df: DataFrame, order: Sequence[str] = ("seq",), key: str = KEY) -> DataFrame:
    """The last row of each key in the given order."""
    return _best_per_key(df, key, [F.col(c).desc() for c in order])


def union_by_name(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; a column only one side has is NULL on the other."""
    return existing.unionByName(new, allowMissingColumns=True)


def merge_keep_last(
    existing: DataFrame,
    new: DataFrame,
    order: Sequence[str] = ("batch_id", "seq"),
    key: str = KEY,
) -> DataFrame:
    """Union, then the last row of each key. Plain append when there is no key."""
    both = union_by_name(existing, new)
    return dedup_last(both, order, key) if key in both.columns else both


def without_keys(
    existing: DataFrame, new: DataFrame, key: str = KEY, broadcast: bool = False
) -> DataFrame:
    """Existing rows whose key does not come again in ``new``; NULL equals NULL.

    Ask for ``broadcast`` only after counting ``new``; otherwise the optimizer
    chooses. Keys are made distinct first, so a frequent one is sent once.
    """
    keys = new.select(F.col(key).alias("_new_key")).distinct()
    if broadcast:
        keys = F.broadcast(keys)
    return existing.join(keys, F.col(key).eqNullSafe(F.col("_new_key")), "left_anti")


def merge_anti_join(
    existing: DataFrame,
    new: DataFrame,
    order: Sequence[str] = ("batch_id", "seq"),
    key: str = KEY,
    broadcast: bool = False,
) -> DataFrame:
    """The merge for a ``new`` side that is later than all of ``existing``.

    Existing rows whose key comes again are dropped, the rest stay where they
    are. ``existing`` must hold one row per key.
    """
    return union_by_name(
        without_keys(existing, new, key, broadcast), dedup_last(new, order, key)
    )


def duplicate_counts(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows, distinct keys (NULL is one) and rows a deduplication removes."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"),
    )
