"""Stored tables: Parquet snapshots, sorted ones for deep pages, and catalog tables bucketed by id.

A snapshot is a new folder; readers take the newest finished one, so a failed write leaves
the one before it in place.
"""

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import nothing

SNAPSHOT = "v={:010d}"

# Rows of one file of a sorted snapshot, the least a page reads.
RANGE_ROWS = 1_000_000
RANGES = "_file string, _first long, _n long"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_file(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.getFileStatus(hadoop_path).isFile()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Finished snapshots below ``root``, oldest first."""
    fs, path = _filesystem(spark, root)
    if not fs.exists(path):
        return []
    found = []
    for entry in fs.listStatus(path):
        match = re.fullmatch(r"v=(\d+)", entry.getPath().getName())
        if match and _finished(spark, entry.getPath().toString()):
            found.append(int(match[1]))
    return sorted(found)


def _finished(spark, folder):
    fs, path = _filesystem(spark, f"{folder}/_SUCCESS")
    return fs.exists(path)


def table_names(spark: SparkSession, root: str) -> list[str]:
    """The tables below ``root``: folders with at least one finished snapshot."""
    fs, path = _filesystem(spark, root)
    names = [e.getPath().getName() for e in fs.listStatus(path) if e.isDirectory()] if fs.exists(path) else []
    return sorted(name for name in names if versions(spark, f"{root}/{name}"))


def read_snapshot(spark: SparkSession, root: str, schema, before: int | None = None):
    """(version, rows) of the newest snapshot, or of the newest older than ``before``;
    version None and no rows when there is none."""
    known = [v for v in versions(spark, root) if before is None or v < before]
    if not known:
        return None, nothing(spark, schema)
    return known[-1], spark.read.schema(schema).parquet(f"{root}/{SNAPSHOT.format(known[-1])}")


def write_snapshot(
    df: DataFrame, root: str, version: int | None = None, check: Callable[[], None] | None = None, **options
) -> int:
    """Write the next snapshot (or the given one again) and return its number. ``options`` go to
    the Parquet writer (see :func:`lookup_options`).

    With ``check`` the files are written beside the snapshots first; only if ``check`` raises
    nothing, they become one.
    """
    spark = df.sparkSession
    if version is None:
        version = max(versions(spark, root), default=-1) + 1
    target = f"{root}/{SNAPSHOT.format(version)}"
    if check is None:
        df.write.mode("overwrite").options(**options).parquet(target)
        return version
    pending = f"{root}/pending-{uuid.uuid4().hex}"
    fs, path = _filesystem(spark, pending)
    try:
        df.write.options(**options).parquet(pending)
        check()
        _, final = _filesystem(spark, target)
        fs.delete(final, True)  # what a write that failed may have left under this number
        if not fs.rename(path, final):
            raise OSError(f"{pending} could not be renamed to {target}")
    finally:
        fs.delete(path, True)
    return version


def lookup_options(*columns: str, distinct: int = 1_000_000) -> dict[str, str]:
    """Writer options for point lookups: a Bloom filter of each column in every row group, sized for
    ``distinct`` values of a group, by which a lookup skips the groups that lack its value."""
    out = {}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct)
    return out


def write_sorted(
    df: DataFrame, root: str, key: str = "id", version: int | None = None, range_rows: int = RANGE_ROWS
) -> int:
    """Write the next snapshot in the order of ``key`` and, beside it, the place of each file's first
    row; its files hold at most ``range_rows`` rows. See :func:`read_page`."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(key).sortWithinPartitions(key)
    version = write_snapshot(ranged, root, version, maxRecordsPerFile=range_rows)
    folder = f"{root}/{SNAPSHOT.format(version)}"
    counts = spark.read.schema(df.schema).parquet(folder).groupBy(F.col("_metadata.file_name").alias("file"))
    places, first = [], 0
    # One row per file, in the order of tasks and then of their files.
    for name, n in sorted(counts.count().collect(), key=lambda r: _file_place(r["file"])):
        places.append((name, first, n))
        first += n
    index = spark.createDataFrame(places, RANGES)
    index.coalesce(1).write.mode("overwrite").parquet(f"{root}/ranges-{SNAPSHOT.format(version)}")
    return version


def _file_place(name: str) -> tuple[int, int]:
    found = re.match(r"part-(\d+)-.*-c(\d+)\.", name)
    return int(found[1]), int(found[2])


def read_page(spark: SparkSession, root: str, schema, limit: int | None = None, offset: int = 0) -> DataFrame:
    """``limit`` rows of the newest sorted snapshot after skipping ``offset``, in its order. Only the
    files that hold the page are opened, whatever its depth and size."""
    newest = SNAPSHOT.format(versions(spark, root)[-1])
    held = spark.read.schema(RANGES).parquet(f"{root}/ranges-{newest}").filter(F.col("_first") + F.col("_n") > offset)
    if limit is not None:
        held = held.filter(F.col("_first") < offset + limit)
    files = [r["_file"] for r in held.select("_file").collect()] if limit != 0 else []
    if not files:
        return nothing(spark, schema)
    rows = spark.read.schema(schema).parquet(*[f"{root}/{newest}/{name}" for name in files])
    names = rows.columns
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    rows = rows.join(held, "_file").withColumn("_at", F.col("_first") + F.col("_row")).filter(F.col("_at") >= offset)
    if limit is not None:
        rows = rows.filter(F.col("_at") < offset + limit)
    return rows.orderBy("_at").select(names)


def save_bucketed(df: DataFrame, table: str, buckets: int, key="id", path: str | None = None):
    """Save as a catalog table bucketed and sorted by ``key``: keyed writes and lookups against
    it then move only the smaller side."""
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
