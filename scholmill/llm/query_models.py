"""Queries of the operators that learn from labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholmill.llm import quality
from scholmill.llm.language_id import held_out, identify, train


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").withColumn("held_out", held_out(modulus=4, remainder=2))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs, model, carry=("doc_id", "held_out"), spans=False).drop("spans")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("held_out", held_out(modulus=5, remainder=0))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(modulus=5, remainder=0))
    ranker = quality.train(docs.filter(~F.col("held_out")), labels, "quality", cut=0.3)
    return quality.score(docs, ranker, carry=("doc_id", "held_out"))
