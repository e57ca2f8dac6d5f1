"""Incremental extraction: new files of the snapshot only, by a file stream that stops when all is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholmill.operators.extract import accepted, latest, not_yet, project
from scholmill.sources.works import parse_snapshot


def extract_new_files(spark: SparkSession, path: str, output: str, checkpoint: str, start_year: int, end_year: int, years: list[int], glob: str = "part_*.gz") -> None:
    """Appends the works of files not seen before to ``output``, in folders by date; ids that it has already are left out.

    The stream's checkpoint remembers the files, so a run after a failure goes on where the last one ended. Rows of a file that are extracted
    twice meet their own ids in the output and add nothing.
    """
    lines = spark.readStream.schema("value string, updated_date string").option("pathGlobFilter", glob).option("basePath", path).format("text").load(path)
    lines = lines.select("value", "updated_date", F.col("_metadata.file_path").alias("file_path"))

    def write(batch: DataFrame, _: int) -> None:
        rows = parse_snapshot(batch.withColumn("line_no", F.monotonically_increasing_id()))
        works = latest(project(accepted(rows, start_year, end_year), years, keep=("updated_date", "file_path", "line_no")), order=("file_path", "line_no"))
        try:
            done = spark.read.parquet(output)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = None  # the first run
        new = works if done is None else not_yet(works.withColumn("updated_date", F.col("updated_date").cast("string")), done.withColumn("updated_date", F.col("updated_date").cast("string")))
        new.drop("file_path", "line_no").write.mode("append").partitionBy("updated_date").parquet(output)

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
