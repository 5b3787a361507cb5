"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on the first one; the others only on speed.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "requestmill", **settings: str) -> SparkSession:
    """A session with the library's settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SESSION_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Wall-clock times are kept as they are read, so the zone has to be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set runtime settings for one write, then put the former ones back."""
    former = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in former.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    A temporary folder stands in for it only on a local master, where the one
    machine is the whole cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "requestmill")


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
