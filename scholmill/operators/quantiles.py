"""Exact order statistics of many groups without a buffer of their values.

A first pass counts each column's values by bucket: small values alone, larger ones by their leading bits, so that a bucket is at most 1/64 of its values
wide. Such counts are a sketch that partial results add up to, and ranks are exact in it: it tells in which bucket a wanted rank lies and how many values
stand before. Buckets of one value are the answer. The others are brackets, and a further pass counts only what lies inside them, by up to 4096 equal
parts, until a part is one value (one more pass for values below 262,144). What is shuffled and ordered is counts by bucket, a few thousand for a
group and column at most, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholmill.operators.durable import cut

#: Leading bits that tell large values' buckets apart, and bits of the parts of a bracket.
LEADING = 7
PARTS = 12


@dataclass(frozen=True)
class Rank:
    """A wanted value: its name, the column that it is of, and its rank from 1 as an expression of ``n``."""

    name: str
    column: str
    rank: str


def percentile(name: str, column: str, p: int) -> Rank:
    """The smallest value that p percent (a whole number) of all do not exceed."""
    return Rank(name, column, f"greatest(cast(ceil(cast({p} AS decimal(20,0)) * n / 100) AS long), 1L)")


def middle(column: str, lower: str = "_low", upper: str = "_high") -> list[Rank]:
    """The two values whose mean is the median."""
    return [Rank(lower, column, "(n + 1) div 2"), Rank(upper, column, "n div 2 + 1")]


def _bucket(x: str) -> str:
    """Numbers of buckets in the order of values; of a negative value that of -x - 1, mirrored."""
    y = f"IF({x} < 0, ~{x}, {x})"
    bits = f"length(bin({y}))"
    large = f"({bits} * {1 << LEADING} + shiftright({y}, {bits} - {LEADING}))"
    return f"CASE WHEN {x} BETWEEN 0 AND {(1 << LEADING) - 1} THEN {x} WHEN {y} < {1 << LEADING} THEN ~{y} WHEN {x} < 0 THEN ~{large} ELSE {large} END"


def _bounds(bucket: Column) -> tuple[Column, Column]:
    """The smallest and the largest value of a bucket."""
    b = F.when(bucket < 0, F.bitwise_not(bucket)).otherwise(bucket).cast("long")
    shift = (F.floor(b / (1 << LEADING)) - LEADING).cast("int")
    lead = b % (1 << LEADING)
    small = b < (1 << LEADING)
    low = F.when(small, b).otherwise(F.call_function("shiftleft", lead, shift))
    high = F.when(small, b).otherwise(low + (F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1))
    return F.when(bucket < 0, F.bitwise_not(high)).otherwise(low), F.when(bucket < 0, F.bitwise_not(low)).otherwise(high)


def _picked(counts: DataFrame, wanted: DataFrame, keys: list[str], at: list[str], part: str) -> DataFrame:
    """``wanted`` with the part of its bracket that holds its rank, and ``before`` it: counts has n_part rows for each part, in the order of ``part``."""
    running = F.sum("n_part").over(Window.partitionBy(*keys, *at).orderBy(part).rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("cum", running).join(wanted, [*keys, *at]).filter("need > below + cum - n_part AND need <= below + cum")


def settle(groups: DataFrame, rows: DataFrame, keys: list[str], ranks: list[Rank], weight: str | None = None) -> DataFrame:
    """``groups`` (keys, n: their rows, and other columns) with a column for each rank. Columns of ranks are long and never null in ``rows``; keys are not null.

    ``weight`` is a column with the number of equal rows that a row stands for.
    """
    if not ranks:
        return groups
    columns = list(dict.fromkeys(r.column for r in ranks))
    held = [] if weight is None else [weight]
    each = rows.select(*keys, *held, *columns).unpivot([*keys, *held], columns, "_column", "_x")
    n_part = (F.count("*") if weight is None else F.sum(weight)).alias("n_part")
    wanted = groups.select(*keys, F.explode(F.array(*(F.struct(F.lit(r.name).alias("_rank"), F.lit(r.column).alias("_column"), F.expr(r.rank).alias("need")) for r in ranks))).alias("w")).select(*keys, "w.*", F.lit(0).cast("long").alias("below"))
    counts = each.groupBy(*keys, "_column", F.expr(_bucket("_x")).alias("_part")).agg(n_part)
    low, high = _bounds(F.col("_part"))
    state = ["_rank", "_column", "need", "below", "lo", "hi"]
    found = cut(_picked(counts, wanted, keys, ["_column"], "_part").select(*keys, "_rank", "_column", "need", (F.col("below") + F.col("cum") - F.col("n_part")).alias("below"), low.alias("lo"), high.alias("hi")))
    done = [found.filter("lo = hi")]
    open_ = found.filter("lo < hi")
    while not open_.isEmpty():
        brackets = open_.select(*keys, "_column", "lo", "hi").distinct()
        size = f"greatest(length(bin(hi - lo)) - {PARTS}, 0)"
        part = F.expr(f"shiftright(_x - lo, {size})")
        inside = each.join(brackets, [*keys, "_column"]).filter("_x BETWEEN lo AND hi").groupBy(*keys, "_column", "lo", "hi", part.alias("_part")).agg(n_part)
        told = _picked(inside, open_, keys, ["_column", "lo", "hi"], "_part").withColumn("below", F.col("below") + F.col("cum") - F.col("n_part"))
        start = F.expr(f"lo + shiftleft(_part, {size})")
        told = told.select(*keys, "_rank", "_column", "need", "below", start.alias("lo"), F.expr(f"lo + shiftleft(_part, {size}) + (shiftleft(1L, {size}) - 1)").alias("hi"))
        told = cut(told.select(*keys, *state))
        done.append(told.filter("lo = hi"))
        open_ = told.filter("lo < hi")
    values = done[0]
    for df in done[1:]:
        values = values.unionByName(df)
    wide = values.groupBy(*keys).agg(*(F.max(F.when(F.col("_rank") == r.name, F.col("lo"))).alias(r.name) for r in ranks))
    return groups.join(wide, keys)
