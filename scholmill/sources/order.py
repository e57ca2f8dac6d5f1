"""Consecutive numbers of rows in the order of files and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PLACE = ["_file", "_block"]


def placed(read: DataFrame) -> DataFrame:
    """A file scan with where each row stands: its file, the block of the file, and an id that grows within the block."""
    return read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows of ``placed`` with their number from 0 by file name, then line, whatever task reads which block.

    Rows are counted by block first; the sums over the blocks before (one row a block of a file) are where each block starts.
    """
    blocks = rows.groupBy(*_PLACE).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select(*_PLACE, "_first", F.coalesce(before, F.lit(0).cast("long")).alias("_start"))
    return rows.join(starts, _PLACE).withColumn(name, F.col("_start") + F.col("_id") - F.col("_first")).drop(*_PLACE, "_id", "_first", "_start")
