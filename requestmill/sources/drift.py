"""Fields of landed JSON records that the schema does not have, or has with another type.

Reading by a schema leaves unknown fields out without a word. Here records are read as VARIANT, which
keeps whatever they hold: fields and types are counted, and values beyond the schema are rescued.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill import schemas as S

RESCUED = "_rescued"
REPORT = "field string, type string, is_known boolean, n_records long, n_all long, least string, most string"


def landed_lines(spark: SparkSession, path: str, paths: Sequence[str] | None = None) -> DataFrame:
    """(value, file): records as text, a line each."""
    lines = spark.read.text(path if paths is None else list(paths))
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def as_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines and ``record``, the text as VARIANT: NULL where it is no JSON object, or has a field twice."""
    parsed = F.try_parse_json(F.col(column))
    return lines.withColumn("record", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed))


def landed_schema(records: DataFrame) -> DataFrame:
    """(schema): one type that all records fit, VARIANT where a field has several."""
    return records.agg(F.schema_of_variant_agg("record").alias("schema"))


def field_counts(records: DataFrame, known: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """(field, type, is_known, n_records, n_all, least, most): what the records hold at their top level.

    Whole and exact numbers are DECIMAL whatever their width; VOID is a JSON null. ``least`` and ``most``
    are the first and the last value as text. A field with several types has several rows. Counts are
    partial before they are shuffled, so a field that all records have costs a row for each task.
    """
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kind = F.when(kind == "BIGINT", "DECIMAL").otherwise(kind)
    # objects and arrays have no plain text
    text = F.coalesce(F.try_variant_get("value", "$", "string"), F.to_json("value"))
    each = (
        records.select("record")
        .where("record IS NOT NULL")
        .lateralJoin(records.sparkSession.tvf.variant_explode(F.col("record").outer()))
        .select(F.col("key").alias("field"), kind.alias("type"), text.alias("text"))
    )
    counted = each.groupBy("field", "type").agg(
        F.count("*").alias("n_records"), F.min("text").alias("least"), F.max("text").alias("most")
    )
    total = records.agg(F.count("record").alias("n_all"))  # one row
    return counted.join(total).select(
        "field",
        "type",
        F.col("field").isin(list(known.names)).alias("is_known"),
        "n_records",
        "n_all",
        "least",
        "most",
    )


def summed(counts: DataFrame) -> DataFrame:
    """Counts of several runs put together; ``share`` is of all records of all runs."""
    runs = counts.groupBy("run").agg(F.max("n_all").alias("n_all"))
    total = runs.agg(F.sum("n_all").alias("n_all"))
    fields = counts.groupBy("field", "type", "is_known").agg(
        F.sum("n_records").alias("n_records"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    share = F.round(F.col("n_records") / F.col("n_all"), 6)
    return fields.join(total).withColumn("share", share).drop("n_all")


def with_rescued(lines: DataFrame, known: T.StructType = S.RAW_SCHEMA, column: str = "value") -> DataFrame:
    """The fields of the known schema, and ``_rescued``: all other fields as a VARIANT object.

    Rescued values keep their types, nested ones included; NULL where there is none. Other columns of
    ``lines`` stay. What is no object has NULLs.
    """
    text = F.col(column)
    others = F.map_filter(
        F.from_json(text, "map<string,variant>"), lambda k, _: ~k.isin(list(known.names))
    )
    rows = lines.select(
        *[c for c in lines.columns if c != column],
        F.from_json(text, known).alias("__record"),
        F.when(F.size(others) > 0, F.to_variant_object(others)).alias(RESCUED),
    )
    return rows.select(*[c for c in lines.columns if c != column], "__record.*", RESCUED)
