"""Query of the decontamination operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholmill.llm.decontamination import contaminated


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), retrieve=0.6, overlap=0.8, shingle=5)
