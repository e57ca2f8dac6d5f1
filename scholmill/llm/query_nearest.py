"""Query of the nearest-neighbour operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholmill.llm.nearest import nearest


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "id % 20 = 0", k=20)
