"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_percentiles(x: Column | str, shares: list[float]) -> Column:
    """Interpolated percentiles (shares from 0 to 1) as an array; 0 where there is no value."""
    if not shares or any(not 0 <= s <= 1 for s in shares):
        raise ValueError(f"shares must lie between 0 and 1: {shares}")
    found = F.percentile(x, F.array(*[F.lit(float(s)) for s in shares]))
    return F.coalesce(found, F.array(*[F.lit(0.0)] * len(shares)))


def ratio(a: Column, b: Column) -> Column:
    """a / b; 0 where b is 0 or either is missing."""
    return F.coalesce(F.when(b != 0, a / b), F.lit(0.0))


def share_percent(n: Column, of: Column) -> Column:
    """n of ``of`` in percent; 0 where that can't be said."""
    return ratio(F.coalesce(n, F.lit(0)) * 100.0, F.coalesce(of, F.lit(0)))
