"""Reporting tables: create, full refresh, read, and the JDBC equivalents."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill import schemas as S
from requestmill.session import session_conf
from requestmill.sources import files

MILLISECOND_FILES = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS"}


def write_parquet_ms(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with timestamps cut to milliseconds."""
    with session_conf(df.sparkSession, MILLISECOND_FILES):
        df.write.mode(mode).parquet(path)


def column_definitions(
    schema: T.StructType = S.REPORTING_SCHEMA,
    limits: Mapping[str, int] = S.TEXT_LIMITS,
    required: tuple[str, ...] = S.REQUIRED_COLUMNS,
) -> str:
    """Column list of a CREATE TABLE, with VARCHAR limits and NOT NULL."""
    lines = []
    for field in schema:
        kind = field.dataType.simpleString().upper()
        if field.name in limits:
            kind = f"VARCHAR({limits[field.name]})"
        suffix = " NOT NULL" if field.name in required else ""
        lines.append(f"{field.name} {kind}{suffix}")
    return ", ".join(lines)


def create_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType = S.REPORTING_SCHEMA,
    limits: Mapping[str, int] = S.TEXT_LIMITS,
    required: tuple[str, ...] = S.REQUIRED_COLUMNS,
    replace: bool = False,
) -> None:
    """Create the table unless it exists; ``replace`` drops an existing one first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({column_definitions(schema, limits, required)}) "
        f"USING PARQUET LOCATION '{location}'"
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Position, name, type, text limit and nullability of a table's columns."""
    nullable = {c.name: c.nullable for c in spark.catalog.listColumns(name)}
    kinds = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    rows = [(i, c, kinds[c], can) for i, (c, can) in enumerate(nullable.items(), start=1)]
    described = spark.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )
    limit = F.regexp_extract("data_type", r"^varchar\((\d+)\)$", 1).try_cast("int")
    return described.select(
        "position", "column_name", "data_type", limit.alias("max_length"), "nullable"
    )


def as_reporting_rows(processed: DataFrame) -> DataFrame:
    """The processed columns in order, with the types of the reporting table."""
    return processed.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.REPORTING_SCHEMA]
    )


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


REPLACED = "_replaced"  # a hidden file in a folder that a table no longer uses


def _drop_replaced(spark: SparkSession, base: str, stem: str, grace: float) -> None:
    """Delete former folders of a table that were replaced more than ``grace`` seconds ago."""
    for name in files.child_names(spark, base):
        if name.split("~", 1)[0] != stem:
            continue
        mark = f"{base}/{name}/{REPLACED}"
        if files.path_exists(spark, mark) and files.age_seconds(spark, mark) >= grace:
            files.delete_folder(spark, f"{base}/{name}")


def refresh_table(processed: DataFrame, name: str, grace: float = 3600.0) -> None:
    """Replace all rows of the table in one step; a refresh that fails changes nothing.

    Rows go to a new folder through a second table of the same definition, which keeps the
    checks of the first one. Then the first one is pointed to it. Rows are ordered by creation time
    over the files, so reports of a month skip the others' row groups; the key splits a time that many
    rows have. The former folder stays for ``grace`` seconds, for reports that are reading it.
    """
    spark = processed.sparkSession
    old = table_location(spark, name)
    base, _, last = old.rpartition("/")
    stem = last.split("~", 1)[0]
    new = f"{base}/{stem}~{uuid.uuid4().hex}"
    draft = f"{name}_{uuid.uuid4().hex}"
    columns = table_columns(spark, name).collect()
    lines = ", ".join(
        f"{c.column_name} {c.data_type}{'' if c.nullable else ' NOT NULL'}" for c in columns
    )
    spark.sql(f"CREATE TABLE {draft} ({lines}) USING PARQUET LOCATION '{new}'")
    try:
        rows = as_reporting_rows(processed)
        if "created_date" in rows.columns:
            order = [c for c in ("created_date", S.KEY) if c in rows.columns]
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows.write.insertInto(draft)
    except Exception:
        spark.sql(f"DROP TABLE {draft}")
        files.delete_folder(spark, new)
        raise
    spark.sql(f"DROP TABLE {draft}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    files.write_document(spark, f"{old}/{REPLACED}", {"by": new})
    _drop_replaced(spark, base, stem, grace)


def append_table(processed: DataFrame, name: str) -> None:
    """Plain append, as the alternative load does."""
    as_reporting_rows(processed).write.insertInto(name, overwrite=False)


def refresh_jdbc(
    processed: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Truncate the remote table and insert all rows."""
    as_reporting_rows(processed).write.option("truncate", "true").mode("overwrite").jdbc(
        url, table, properties=dict(properties or {})
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    column: str = "created_date",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A remote table; with ``bounds`` on a date or number column, in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **dict(properties or {}))
    if bounds:
        reader = reader.options(
            partitionColumn=column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=str(partitions),
        )
    return reader.load()
