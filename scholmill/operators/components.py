"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.operators.durable import cut


#: Links that one task is meant to handle.
ROWS_A_TASK = 200_000


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes of ``links``.

    Large-star and small-star steps in turn: every node links its neighbours to the smallest one it knows, which is aggregated
    before the shuffle, so that a node with very many neighbours is no hot task. The rounds grow as the logarithm of the
    longest path; lineage is cut in each.
    """
    links = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())  # made by all tasks: few partitions are for what is done with them
    k = max(1, -(-2 * links.count() // ROWS_A_TASK))  # a small graph is kept in few partitions, so that its many exchanges write few files
    edges = links.coalesce(k)
    mark = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(k)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(k).distinct().coalesce(k)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(k)
        small = large.join(least, "u").coalesce(k)
        edges = cut(small.select("u", F.col("m").alias("v")).unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct().coalesce(k))
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        mark = seen
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
