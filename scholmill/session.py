"""Spark sessions with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "scholmill", cores: str = "8", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster, pass your own session to the operators instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the given tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
