"""Query of the packing operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scholmill.llm.packing import pack


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 2048)
