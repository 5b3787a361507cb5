"""Rows in the layout of the alternative incident table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill import schemas as S
from requestmill.operators import clean


def as_incidents(raw: DataFrame, created_at: datetime | str) -> DataFrame:
    """Incident columns in order; those the batch lacks are NULL.

    The table's own number is left to the database that holds it.
    """
    parsed = raw.transform(clean.parse_timestamps, ("created_date",)).transform(
        clean.parse_numbers
    )
    stamped = parsed.withColumn("created_at", F.lit(str(created_at)).cast("timestamp"))
    types = {f.name: f.dataType for f in S.INCIDENT_SCHEMA}
    return clean.add_absent(stamped, types).select(*types)
