"""Replace values by a mapping that is itself a relation, of any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 50  # rough cost of one pair in a broadcast relation besides its texts


@dataclass(frozen=True)
class Mapping:
    """Checked pairs of text and what stands for it, and their measured size."""

    pairs: DataFrame
    n_bytes: int


def checked(pairs: DataFrame, key: str = "key", value: str = "value") -> Mapping:
    """A mapping without NULL keys, equal pairs once. A key with several values is refused.

    Counted in one job that has a row for each key; nothing but three numbers and an example comes back.
    """
    rows = pairs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_from"), F.col(value).cast("string").alias("_to")
    )
    per_key = rows.groupBy("_from").agg(
        F.min("_to").alias("_to"),
        ((F.min("_to") != F.max("_to")) | (F.count("_to") % F.count("*") != 0)).alias("several"),
    )
    size = F.octet_length("_from") + F.coalesce(F.octet_length("_to"), F.lit(0)) + ROW_OVERHEAD
    found = per_key.agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("n_bytes"),
        F.count_if("several").alias("n_several"),
        F.min(F.when(F.col("several"), F.col("_from"))).alias("example"),
    ).first()
    if found["n_several"]:
        raise ValueError(f"{found['n_several']} keys have several values, {found['example']!r} among them")
    return Mapping(per_key.select("_from", "_to"), found["n_bytes"])


def look_up(
    df: DataFrame, column: str, mapping: Mapping, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The values that the mapping has are replaced; others, and those it maps to NULL, pass through.

    Up to ``broadcast_bytes`` the pairs go to every task and ``df`` stays where it is. Beyond, both sides are
    shuffled by the text; a value that many rows have is split by the adaptive skew join, as the
    mapping has it once.
    """
    if column not in df.columns:
        return df
    small = mapping.n_bytes <= broadcast_bytes
    pairs = F.broadcast(mapping.pairs) if small else mapping.pairs.hint("merge")
    joined = df.join(pairs, F.col(column) == F.col("_from"), "left")
    return joined.select(
        *(F.coalesce("_to", F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns)
    )
