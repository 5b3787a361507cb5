"""A raw request relation, and two increments of it, derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS"
_BOROUGHS = ("Queens", "brooklyn ", "MANHATTAN", "Bronx", "Staten Island", "Unspecified")


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten raw text columns with every flaw the cleaning handles, plus ``seq``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")

    def every(n: int, remainder: int = 0):
        return number % n == remainder

    def null_every(n: int, value):
        return F.when(~every(n), value)

    stamp = F.date_format("ts", _STAMP)
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"), F.lit(0))
    still_open = kind.isin("click", "view")
    borough = F.element_at(
        F.array(*[F.lit(b) for b in _BOROUGHS]), (user % len(_BOROUGHS) + 1).cast("int")
    )
    columns = {
        "unique_key": F.when(every(10, 9), number - 1).otherwise(number).cast("string"),
        "created_date": F.when(every(97), "not-a-date").otherwise(stamp),
        "closed_date": F.when(still_open, F.lit(None))
        .when(kind == "error", F.date_format(F.col("ts") - span, _STAMP))
        .otherwise(F.date_format(F.col("ts") + span, _STAMP)),
        "agency": F.when(every(11), F.lit(None))
        .when(every(13), " nan ")
        .otherwise(F.concat(F.lit("  "), kind, F.lit(" "))),
        "complaint_type": null_every(
            17, F.concat(F.lit("type "), F.get_json_object("props", "$.k"))
        ),
        "descriptor": null_every(7, F.concat(F.lit("user "), user.cast("string"))),
        "borough": null_every(19, borough),
        "status": F.when(still_open, "Open").otherwise("Closed"),
        "latitude": F.when(every(23), F.lit(None))
        .when(every(29), "abc")
        .otherwise(((4030 + number % 90) / 100).cast("string")),
        "longitude": null_every(31, (-(7360 + number % 100) / 100).cast("string")),
        "seq": number,
    }
    return events.select(*[value.alias(name) for name, value in columns.items()])


def increments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping batches; the second one closes every request in it."""
    raw = raw_requests(spark, sf_dir)
    tail = F.col("seq") % 10
    first = raw.where(tail < 7).withColumn("batch_id", F.lit(1))
    second = (
        raw.where(tail >= 5)
        .withColumn("status", F.lit("Closed"))
        .withColumn("batch_id", F.lit(2))
    )
    return first, second
