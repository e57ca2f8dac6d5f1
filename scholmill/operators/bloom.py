"""Blocked Bloom filters as tables of bitmaps, which merge by an aggregate.

An id belongs to one of ``blocks`` bitmaps of 32768 bits by its hash, and sets a few bits there. Filters of the same number of blocks are merged block by
block. A filter of too few blocks for its ids only lets more of them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768
HASHES = 4
#: Bytes of bitmaps that may be sent to every task.
BROADCAST = 64 << 20


def blocks_for(ids: int, bits_an_id: int = 12) -> int:
    return max(1, -(-ids * bits_an_id // BLOCK_BITS))


def fits(blocks: int) -> bool:
    """Whether a filter is small enough for a broadcast."""
    return blocks * BLOCK_BITS // 8 <= BROADCAST


def _block(x: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(x), F.lit(blocks))


def _bits(x: Column) -> Column:
    return F.array(*(F.pmod(F.xxhash64(F.lit(k), x), F.lit(BLOCK_BITS)) for k in range(1, HASHES + 1)))


def bloom(ids: DataFrame, column: str, blocks: int) -> DataFrame:
    """(block, bits) of the ids; nulls are left out."""
    x = F.col(column)
    rows = ids.filter(x.isNotNull()).select(_block(x, blocks).alias("block"), F.explode(_bits(x)).alias("bit"))
    return rows.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def with_maybe(df: DataFrame, column: str, filters: DataFrame, blocks: int, name: str = "maybe") -> DataFrame:
    """Adds whether the filter may have the id (never false for one that it has). ``filters`` is broadcast, so ask ``fits`` first."""
    if not fits(blocks):
        raise ValueError(f"a filter of {blocks} blocks is too large for a broadcast")
    x = F.col(column)
    held = df.withColumn("_block", _block(x, blocks)).join(F.broadcast(filters.select(F.col("block").alias("_block"), F.col("bits").alias("_bitmap"))), "_block", "left")
    byte = "cast(conv(hex(substring(_bitmap, cast(b div 8 + 1 AS int), 1)), 16, 10) AS int)"
    every = F.expr(f"forall(_asked, b -> getbit({byte}, cast(b % 8 AS int)) = 1)")
    held = held.withColumn("_asked", _bits(x)).withColumn(name, F.coalesce(x.isNotNull() & F.col("_bitmap").isNotNull() & every, F.lit(False)))
    return held.drop("_block", "_bitmap", "_asked")
