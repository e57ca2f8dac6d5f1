"""Article records as JSON lines, resolved articles, and the journal metadata table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholmill.sources.order import numbered, placed

RECORD_SCHEMA = "collection_acronym string, publisher_id string, publication_year string, doi string, doi_and_lang array<struct<lang: string, doi: string>>, document_type string, original_title string, translated_titles map<string,string>, journal struct<title: string, any_issn: string, scielo_issn: string, electronic_issn: string, print_issn: string>"
RESOLVED_SCHEMA = "collection array<string>, pid_v2 array<string>, publication_year int, doi_with_lang map<string,string>, doi string, titles array<string>, document_type string, journal_title string, journal_issns array<string>, article_idx long"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Article records, numbered (doc_idx) by file and line."""
    return numbered(placed(spark.read.schema(RECORD_SCHEMA).json(path)), "doc_idx")


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESOLVED_SCHEMA).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Resolved articles or the merge audit as JSON lines."""
    df.write.mode("overwrite").json(path)


def category_vocabulary(spark: SparkSession, path: str, level: str, glob: str | None = None) -> DataFrame:
    """Quoted category names of a level, one a line; a level without a file has none."""
    from scholmill.operators.cohorts import LEVELS

    if level not in LEVELS:
        return spark.createDataFrame([], "category_id string")
    lines = spark.read.option("pathGlobFilter", glob or f"{level}.txt").text(path)
    return lines.select(F.expr("trim(BOTH '\"' FROM trim(value))").alias("category_id")).filter("category_id <> ''")
