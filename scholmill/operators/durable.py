"""Cutting lineage with copies that survive a lost executor."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only where none is set and the master is this machine (as in tests) a new folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder, and read from there."""
    path = f"{scratch(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Here the shuffle files of a query go as soon as it has ended; else they stay until the driver collects its garbage. For queries whose result is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
