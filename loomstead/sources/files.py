"""Source files of an ingest: listing, the manifest and the quarantine."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MANIFEST_SCHEMA, QUARANTINE_SCHEMA


def list_files(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """Path and modification time of the files below ``root``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return found.option("pathGlobFilter", glob).load(root).select(
        "path", F.col("modificationTime").cast("double").alias("mtime")
    )


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files not in the manifest yet, as pending manifest rows."""
    unseen = files.join(manifest.select("path"), "path", "left_anti")
    return unseen.select(
        "path",
        F.lit("pending").alias("status"),
        "mtime",
        F.lit(None).cast("long").alias("drawers"),
        F.lit(None).cast("timestamp").alias("ts"),
    )


def discover(spark: SparkSession, root: str, manifest: DataFrame, glob: str = "*.jsonl") -> DataFrame:
    return new_files(list_files(spark, root, glob), manifest)


def current_manifest(entries: DataFrame) -> DataFrame:
    """One row per file: done outranks pending, then the latest entry."""
    rank = F.struct((F.col("status") == "done").alias("done"), "ts")
    rest = [c for c in MANIFEST_SCHEMA.names if c != "path"]
    return entries.groupBy("path").agg(F.max_by(F.struct(*rest), rank).alias("e")).select("path", "e.*")


def record_skips(bad: DataFrame, path: str):
    """Append rows that could not be stored to the quarantine, as JSON lines."""
    bad.select(QUARANTINE_SCHEMA.names).write.mode("append").json(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).json(path)
