"""Texts compared as a database with a case-insensitive, blank-padding collation does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLLATION = "UTF8_LCASE_RTRIM"  # neither case nor blanks at the end tell texts apart


def collated(column: str | Column, collation: str = COLLATION) -> Column:
    """The text under a collation, for joins, groups, DISTINCT and comparisons."""
    return F.collate(column, collation)


def value_counts(df: DataFrame, column: str, collation: str = COLLATION) -> DataFrame:
    """(value, n_rows, n_spellings) of each text under the collation; NULL is one of them.

    The value shown is the most frequent spelling, of equally frequent ones the first by its bytes, so it
    does not depend on the order of rows. Rows are counted by spelling first, so a frequent text is no hot
    key, and no list of spellings is gathered. An empty relation has no values.
    """
    spellings = df.groupBy(F.col(column).alias("_text")).agg(F.count("*").alias("_n"))
    return (
        spellings.groupBy(collated("_text", collation).alias("_key"))
        .agg(
            F.min_by("_text", F.struct(-F.col("_n"), F.col("_text"))).alias("value"),
            F.sum("_n").alias("n_rows"),
            F.count("*").alias("n_spellings"),
        )
        .drop("_key")
    )
