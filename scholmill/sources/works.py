"""Works: the raw snapshot and Parquet datasets of flat works."""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholmill.operators.durable import written

_SOURCE = "struct<id: string, type: string, issn_l: string, is_oa: boolean>"
_NAMED = "struct<display_name: string>"
RAW_SCHEMA = f"id string, type string, is_xpac boolean, publication_year int, language string, doi string, cited_by_count long, primary_location struct<source: {_SOURCE}>, locations array<struct<source: {_SOURCE}>>, primary_topic struct<display_name: string, score: double, domain: {_NAMED}, field: {_NAMED}, subfield: {_NAMED}>, counts_by_year array<struct<year: int, cited_by_count: long>>"


def read_snapshot(spark: SparkSession, path: str, glob: str = "part_*.gz", partitions: int | None = None) -> DataFrame:
    """Raw JSON lines of folders ``updated_date=...``: value, updated_date, file and line order.

    A gzip file is one task; ``partitions`` spreads its rows after reading.
    """
    lines = spark.read.option("basePath", path).option("recursiveFileLookup", "false").option("pathGlobFilter", glob).text(path)
    lines = lines.select("value", F.col("updated_date").cast("string").alias("updated_date"), F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("line_no"))
    return lines.repartition(partitions) if partitions else lines


def parse_snapshot(lines: DataFrame) -> DataFrame:
    """Raw works of JSON lines, with the columns that order them; what isn't valid gives nulls."""
    keep = [c for c in lines.columns if c != "value"]
    # a generator, so that filters don't parse the text again for each field that they look at
    return lines.select(F.inline(F.array(F.from_json("value", RAW_SCHEMA))), *keep)


def _footers(batches):
    """(folder, path, signature) of files, from their footers; a file system that Arrow can't open leaves the path as signature."""
    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            scheme, _, rest = path.partition(":")
            try:
                fs, name = (pafs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else pafs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe=":/"))
            except pa.ArrowInvalid:  # an unknown scheme, not an unreadable file
                signature = path
            else:
                with fs.open_input_file(name) as f:
                    footer = pq.read_metadata(f)
                own = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
                signature = hashlib.sha256(str(footer.schema).split("\n", 1)[1].encode() + own).hexdigest()
            rows.append({"folder": path.rsplit("/", 1)[0], "path": path, "signature": signature})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("folder", pa.string()), ("path", pa.string()), ("signature", pa.string())]))


def read_works(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset with files of different schemas: columns by name, missing ones null, numbers widened.

    Footers are read in tasks. To the driver come one row for each folder and schema, and the names of files only of folders that hold files of
    several schemas, or files beside folders; it opens one file for each schema. Files of a schema are one scan, with its filters and columns pushed
    down, and each is cast, as one file's long and another's double can't be merged by the reader. Empty files are skipped. On a file system
    that Arrow can't open, every file counts as a schema of its own.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0").select("path")
    files = files.filter(~F.col("path").rlike("/[_.][^/]*$")).coalesce(4 * spark.sparkContext.defaultParallelism)  # else a task for each file
    footers = written(files.mapInArrow(_footers, "folder string, path string, signature string"))
    held = footers.groupBy("folder", "signature").agg(F.min("path").alias("path")).collect()
    if not held:
        raise ValueError(f"no Parquet files under {path}")
    folders = sorted(f"{r['folder']}/" for r in held)
    whole = {f for f, after in zip(folders, [*folders[1:], ""]) if not after.startswith(f)} - {f for f, n in Counter(folders).items() if n > 1}
    parts = [(r["signature"], r["folder"]) for r in held if f"{r['folder']}/" in whole]
    rest = [(f.rstrip("/"),) for f in {*folders} - whole]
    if rest:
        parts += map(tuple, footers.join(spark.createDataFrame(rest, "folder string"), "folder", "left_semi").select("signature", "path").collect())
    kinds = {s: spark.read.parquet(one).schema.json() for s, one in {r["signature"]: r["path"] for r in held}.items()}
    groups: dict[str, list[str]] = {}
    for signature, part in sorted(parts):
        groups.setdefault(kinds[signature], []).append(part)
    frames = [spark.read.option("basePath", path).schema(T.StructType.fromJson(json.loads(s))).parquet(*ps) for s, ps in groups.items()]
    return union_by_name(frames)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; a column that is long in one frame and double in another is double."""
    rank = {"int": 0, "bigint": 1, "double": 2}
    widest: dict[str, str] = {}
    for df in frames:
        for name, kind in df.dtypes:
            if kind in rank:
                widest[name] = max(widest.get(name, kind), kind, key=rank.__getitem__)
    cast = [df.select(*[F.col(n).cast(widest[n]).alias(n) if k in rank else F.col(n) for n, k in df.dtypes]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def write_works(works: DataFrame, path: str) -> None:
    """Appends flat works, in folders by date."""
    works.write.mode("append").partitionBy("updated_date").parquet(path)


def write_merged(merged: DataFrame, path: str) -> None:
    merged.write.mode("overwrite").parquet(path)
