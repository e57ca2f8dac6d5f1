"""Incremental runs over a snapshot with a ledger of what has been read.

A store has three tables, each in folders by run: ``works``, ``filters`` (a Bloom filter of the run's work ids) and ``ledger`` (updated_date, file_path,
n_works of each file that was read, also of those without works). A run writes its works and filter first and its part of the ledger last, as one file:
only then it counts. What a run that failed has left is never read, and the next one reads its files again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scholmill.operators import bloom as B
from scholmill.operators import extract as E
from scholmill.operators.durable import written
from scholmill.sources.works import parse_snapshot

LEDGER = "updated_date string, file_path string, n_works long, run string"


def _table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table, or None where nothing has been written yet."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.option("basePath", path).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """What committed runs have read."""
    found = _table(spark, f"{store}/ledger", LEDGER)
    return spark.createDataFrame([], LEDGER) if found is None else found


def _committed(spark: SparkSession, store: str, name: str) -> DataFrame | None:
    found = _table(spark, f"{store}/{name}")
    if found is None:
        return None
    runs = [r[0] for r in read_ledger(spark, store).select("run").distinct().collect()]  # one a run; their folders are all that is scanned
    return found.filter(F.col("run").isin(runs)) if runs else None


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """Works of all committed runs, or None."""
    return _committed(spark, store, "works")


def snapshot_files(spark: SparkSession, snapshot: str, glob: str) -> DataFrame:
    """updated_date, file_path and path (to read it by) of a snapshot's files; a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("basePath", snapshot).option("pathGlobFilter", glob).load(snapshot)
    return files.select(F.col("updated_date").cast("string").alias("updated_date"), F.col("_metadata.file_path").alias("file_path"), "path")


def unread(spark: SparkSession, snapshot: str, store: str, glob: str = "part_*.gz", by: str = "date") -> DataFrame:
    """Files to read: of dates that no run has read (``date``), or files that none has (``file``)."""
    key = {"date": "updated_date", "file": "file_path"}.get(by)
    if key is None:
        raise ValueError(f"by must be date or file: {by!r}")
    return snapshot_files(spark, snapshot, glob).join(read_ledger(spark, store).select(key).distinct(), key, "left_anti")


def without_known(works: DataFrame, known: DataFrame | None, filters: DataFrame | None, blocks: int) -> DataFrame:
    """Works whose id ``known`` doesn't have. With a filter small enough only those that it lets through meet ``known`` in a join."""
    if known is None:
        return works
    ids = known.select("work_id").distinct()
    if filters is None or not B.fits(blocks):
        return works.join(ids, "work_id", "left_anti")
    tested = written(B.with_maybe(works, "work_id", B.merged(filters), blocks))  # read twice
    fresh, asked = tested.filter(~F.col("maybe")), tested.filter("maybe")
    return fresh.unionByName(asked.join(ids, "work_id", "left_anti")).drop("maybe")


def run(spark: SparkSession, snapshot: str, store: str, start_year: int, end_year: int, years: list[int], windows=E.WINDOWS, glob: str = "part_*.gz", by: str = "date", expected: int = 10_000_000) -> dict:
    """One run: reads the files that the ledger doesn't have, adds their new works to the store, and commits. Returns its name and counts.

    The counts are observed while the files are parsed: n_lines, n_unread (no work at all), n_malformed, n_no_journal. ``expected`` ids size the filters
    of a store and must stay the same.
    """
    name, blocks = f"{spark.sql('SELECT unix_micros(current_timestamp())').first()[0]:020d}-{uuid.uuid4().hex[:8]}", B.blocks_for(expected)
    files = written(unread(spark, snapshot, store, glob, by))
    paths = [r[0] for r in files.select("path").collect()]  # names of new files, which the reader's listing needs
    if not paths:
        return {"run": None, "n_lines": 0, "n_unread": 0, "n_malformed": 0, "n_no_journal": 0}
    lines = spark.read.option("basePath", snapshot).text(paths)
    lines = lines.select("value", F.col("updated_date").cast("string").alias("updated_date"), F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("line_no"))
    seen = Observation()
    raw = E.observed(parse_snapshot(lines), start_year, end_year, seen, windows)
    works = E.latest(E.project(E.accepted(raw, start_year, end_year, windows), years, windows, keep=("updated_date", "file_path", "line_no")))
    new = without_known(works, read_store(spark, store), _committed(spark, store, "filters"), blocks)
    new.write.parquet(f"{store}/works/run={name}")
    done = spark.read.parquet(f"{store}/works/run={name}")
    B.bloom(done, "work_id", blocks).write.parquet(f"{store}/filters/run={name}")
    counts = done.groupBy("file_path").agg(F.count("*").alias("n_works"))
    rows = files.join(counts, "file_path", "left")
    rows.select("updated_date", "file_path", F.coalesce("n_works", F.lit(0).cast("long")).alias("n_works")).coalesce(1).write.parquet(f"{store}/ledger/run={name}")
    return {"run": name, **seen.get}
