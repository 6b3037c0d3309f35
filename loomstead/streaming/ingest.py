"""Resumable ingest of JSON-lines files into a collection.

The stream checkpoint remembers which files are done; a run takes whatever is new and stops.
Every micro-batch is written to folders named by its number, so a batch that is repeated after
a failure replaces its own output instead of adding to it. The stored rows form a log, and the
collection is its last row per id.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.metadata import default_metadata, is_json_object
from ..operators.embedding import embed_where_missing
from ..operators.writes import PREVIEW_CHARS, last_per_id, split_valid
from ..schemas import COLLECTION_INPUT_SCHEMA, COLLECTION_SCHEMA, MANIFEST_SCHEMA, QUARANTINE_SCHEMA
from ..session import nothing, written
from ..sources.files import current_manifest, discover
from ..sources.tables import SNAPSHOT, versions, write_snapshot

# A line of a source file: a collection row. The last copy of an id counts, by file, then by
# ``line`` where it is given, then by place in the file.
LINE_SCHEMA = StructType(COLLECTION_INPUT_SCHEMA.fields + [StructField("line", LongType())])
# A line that is no JSON, or no such row, is kept as it stands.
UNREADABLE = "line is not a readable row"
UNREADABLE_SCHEMA = StructType([StructField("path", StringType()), StructField("raw", StringType())])


class _RunLimit(Exception):
    """Raised before a batch beyond the limit of this run; the next run starts with it."""


def ingest(
    spark: SparkSession,
    source: str,
    store: str,
    dim: int,
    embedder=None,
    glob: str = "*.jsonl",
    files_per_batch: int = 50,
    limit: int = 0,
    table: str = "collection",
    defaults: dict | None = None,
) -> int:
    """File everything new below ``source`` into ``store``; returns the micro-batches filed.

    ``limit`` stops the run once that many files are filed (0: no limit). ``defaults`` are
    metadata entries for rows that lack them, such as ``{"wing": "history"}``.
    """
    filed = {"batches": 0, "files": 0, "stopped": False}

    def file_batch(lines: DataFrame, number: int):
        if limit and filed["files"] >= limit:
            filed["stopped"] = True
            raise _RunLimit
        rows = lines.withColumn("row", F.monotonically_increasing_id())
        unread = rows.filter("raw IS NOT NULL")
        rows = _with_defaults(rows.filter("raw IS NULL").drop("raw"), defaults)
        good, bad = split_valid(rows, dim, table)
        bad = bad.unionByName(_unreadable_rows(unread, table))
        good = last_per_id(good.withColumn("_order", F.struct("path", "line", "block", "row")), "_order")
        if embedder is not None:
            good = embed_where_missing(good, embedder)
        spot = SNAPSHOT.format(number)
        good.select("path", *COLLECTION_SCHEMA.names).write.mode("overwrite").parquet(f"{store}/rows/{spot}")
        bad.select(QUARANTINE_SCHEMA.names).write.mode("overwrite").json(f"{store}/quarantine/{spot}")
        unread.select("path", "raw").write.mode("overwrite").parquet(f"{store}/unreadable/{spot}")
        done = _batch_manifest(lines, spark.read.parquet(f"{store}/rows/{spot}"))
        done.write.mode("overwrite").parquet(f"{store}/manifest/{spot}")
        filed["batches"] += 1
        filed["files"] += spark.read.parquet(f"{store}/manifest/{spot}").count()

    lines = _parsed(
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(source)
        .select("value", F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_block_start").alias("block"),
                F.col("_metadata.file_modification_time").alias("modified"))
    )
    run = (
        lines.writeStream.foreachBatch(file_batch)
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        run.awaitTermination()
    except Exception:
        if not filed["stopped"]:  # by the limit, before its batch did anything
            raise
    return filed["batches"]


def _parsed(lines):
    """The fields of each line (``value``), and as ``raw`` the text of those that can't be read. They
    are parsed as a whole, so a field that does not fit shows whatever columns are asked for."""
    whole = StructType(LINE_SCHEMA.fields + [StructField("_raw", StringType())])
    read = F.from_json("value", whole, {"columnNameOfCorruptRecord": "_raw"})
    rest = [c for c in lines.columns if c != "value"]
    rows = lines.filter("trim(value) <> ''").select("value", read.alias("_read"), *rest)
    raw = F.when(F.col("_read").isNull(), F.col("value")).otherwise(F.col("_read._raw"))
    return rows.select(*[f"_read.{n}" for n in LINE_SCHEMA.names], raw.alias("raw"), *rest)


def _unreadable_rows(unread, table):
    """Quarantine rows of the lines that can't be read; the whole text is kept beside them."""
    return unread.select(
        F.current_timestamp().alias("ts"), F.lit(table).alias("table"), "id",
        F.lit(None).cast("string").alias("source_file"), F.lit(None).cast("string").alias("room"),
        F.lit(UNREADABLE).alias("error"), F.substring("raw", 1, PREVIEW_CHARS).alias("doc_preview"),
    )


def _with_defaults(lines, defaults):
    """Put each default entry in front of the metadata objects that lack it."""
    lines = lines.withColumn("metadata", default_metadata())
    for key, value in (defaults or {}).items():
        body = F.ltrim(F.substr(F.trim("metadata"), F.lit(2)))
        comma = F.when(body.startswith("}"), "").otherwise(",")
        entry = F.lit("{" + json.dumps(key) + ":" + json.dumps(value))
        lacks = is_json_object() & F.get_json_object("metadata", f"$.{key}").isNull()
        lines = lines.withColumn(
            "metadata", F.when(lacks, F.concat(entry, comma, body)).otherwise(F.col("metadata"))
        )
    return lines


def _batch_manifest(lines, good):
    """One done row per file of the batch, with the rows it filed."""
    files = lines.groupBy("path").agg(F.max("modified").cast("double").alias("mtime"))
    drawers = good.groupBy("path").agg(F.count("*").alias("drawers"))
    return files.join(drawers, "path", "left").select(
        "path",
        F.lit("done").alias("status"),
        "mtime",
        F.coalesce("drawers", F.lit(0)).cast("long").alias("drawers"),
        F.current_timestamp().alias("ts"),
    )


def _log(spark, folder, schema, kind="parquet"):
    return spark.read.schema(schema).option("basePath", folder).format(kind).load(folder)


def stored_rows(spark: SparkSession, store: str) -> DataFrame:
    """The collection: the last filed row of every id.

    Only ids and batch numbers are shuffled to find the ids filed more than once; the rows
    these outdate are then left out, without moving the others while such ids are few.
    """
    log = _log(spark, f"{store}/rows", StructType(COLLECTION_SCHEMA.fields + [StructField("v", LongType())]))
    newest = log.groupBy("id").agg(F.max("v").alias("newest"), F.count("*").alias("n")).filter("n > 1")
    refiled = written(newest.select(F.col("id").alias("_id"), "newest"))
    outdated = (F.col("id") == F.col("_id")) & (F.col("v") < F.col("newest"))
    return log.join(refiled, outdated, "left_anti").select(COLLECTION_SCHEMA.names)


def quarantined(spark: SparkSession, store: str) -> DataFrame:
    return _log(spark, f"{store}/quarantine", QUARANTINE_SCHEMA, "json").select(QUARANTINE_SCHEMA.names)


def unreadable(spark: SparkSession, store: str) -> DataFrame:
    """The lines that could not be read, whole, with the path of their file."""
    return _log(spark, f"{store}/unreadable", UNREADABLE_SCHEMA).select(UNREADABLE_SCHEMA.names)


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """One done row per file filed so far."""
    folder = f"{store}/manifest"
    if not versions(spark, folder):
        return nothing(spark, MANIFEST_SCHEMA)
    return current_manifest(_log(spark, folder, MANIFEST_SCHEMA).select(MANIFEST_SCHEMA.names))


def progress(spark: SparkSession, source: str, store: str, glob: str = "*.jsonl") -> DataFrame:
    """The manifest with the files that are still to be filed, as pending rows."""
    filed = manifest(spark, store)
    return filed.unionByName(discover(spark, source, filed, glob))


def compact(spark: SparkSession, store: str, root: str) -> int:
    """Write the collection as it stands to a new snapshot below ``root``."""
    return write_snapshot(stored_rows(spark, store), root)
