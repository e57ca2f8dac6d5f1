"""Query of the personal-data operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholmill.llm.pii import personal_data


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_found")
