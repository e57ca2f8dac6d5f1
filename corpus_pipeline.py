"""The corpus pipeline: from raw documents to packed training sequences.

Each stage reads what the one before it has written, and all but the last return the columns of ``documents``. In all stages a null text
counts as an empty one, texts are read whole, an empty table gives an empty result, and further columns of the input, whatever their
names, are left out. Nulls in lang, source or n_chars pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholmill.llm import decontamination, language_id, line_dedup, near_dedup, packing
from scholmill.operators.durable import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters go (null and empty ones too), and mixtures in which no language holds half of the letters.

    Rows without a language teach nothing; equal rows and rows without doc_id are judged each; of equal shares the first language counts.
    """
    model = language_id.train(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, model, carry=tuple(COLUMNS), spans=False)
    return found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= 0.5)).select(COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of three lines, of one or two with 50 words, and of whole texts of one or two lines go, and documents of which nothing is left.

    Rows of one doc_id count as one document; rows without doc_id come after all others.
    """
    found = line_dedup.line_dedup(docs, min_lines=3, gram=2, min_words=50, carry=("lang", "source"))
    return found.filter(F.col("text").rlike(r"\S")).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that of the smallest doc_id.

    Of rows of one doc_id one stays; rows without doc_id stay.
    """
    return near_dedup.keep_one(docs, threshold=0.8, shingle=5, plain=True).select(COLUMNS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; equal rows and rows without doc_id are judged each, items without text match nothing."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), retrieve=0.6, overlap=0.8, shingle=5).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens; equal rows and rows without doc_id are packed each."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 2048)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("best_fit_packing", pack_sequences),
]

#: The stages use hashes, models and a tokenizer that SQL doesn't have; tests hold run() against the plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
