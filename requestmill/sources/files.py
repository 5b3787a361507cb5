"""Files on the shared file system: inventory, and small JSON documents."""

from __future__ import annotations

import json
import time
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(
    spark: SparkSession, path: str, pattern: str = "*.parquet", latest: int | None = None
) -> DataFrame:
    """Name, size and modification time of files, newest first. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("size_bytes"),
            F.round(F.col("length") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
            F.col("modificationTime").alias("modified"),
        )
        .orderBy(F.desc("modified"), F.asc("file_name"))
    )
    return files.limit(latest) if latest else files


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop path and its file system, which also serves object stores."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _hadoop(spark, path)
    return system.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none when it does not exist."""
    target, system = _hadoop(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def delete_folder(spark: SparkSession, path: str) -> None:
    target, system = _hadoop(spark, path)
    system.delete(target, True)


def age_seconds(spark: SparkSession, path: str) -> float:
    """Time since a file or folder was last changed."""
    target, system = _hadoop(spark, path)
    return time.time() - system.getFileStatus(target).getModificationTime() / 1000


def claim(spark: SparkSession, path: str, expiry: float) -> bool:
    """Create an empty file if there is none; of several callers one succeeds.

    A claim older than ``expiry`` seconds was left by a writer that died and is taken over.
    """
    target, system = _hadoop(spark, path)
    for _ in range(2):
        try:
            # create without overwriting: decided by the name node, on a local disk by a look first
            if system.createNewFile(target):
                return True
        except Exception:
            if not system.exists(target):
                raise
        if age_seconds(spark, path) < expiry:
            return False
        system.delete(target, False)
    return False


def write_document(spark: SparkSession, path: str, document: dict[str, Any]) -> None:
    """Replace a small JSON file in one step: write beside it, then rename over it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, system = _hadoop(spark, path)
    draft, _ = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.draft")
    system.mkdirs(target.getParent())
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(document).encode("utf-8")))
    finally:
        stream.close()
    options = spark._jvm.java.lang.reflect.Array.newInstance(
        spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1
    )
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(system.makeQualified(draft), system.makeQualified(target), options)


def read_document(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """A small JSON file; None only when there is no such file.

    Every other trouble is raised, so an unreadable file is never mistaken for a
    missing one.
    """
    target, system = _hadoop(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        content = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    if not content.strip():
        raise ValueError(f"{path} is empty")
    return json.loads(content)
