"""Table schemas. Metadata and properties are JSON text; temporal values are ISO text."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VECTOR = ArrayType(FloatType(), True)

COLLECTION_INPUT_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("document", StringType()),
        StructField("metadata", StringType()),
        StructField("embedding", VECTOR),
    ]
)

# Metadata keys kept as real columns beside the JSON, so that filters on them reach the
# Parquet scan and grouping reads one narrow column.
PROMOTED = ("wing", "room", "source_file")

COLLECTION_SCHEMA = StructType(
    COLLECTION_INPUT_SCHEMA.fields + [StructField(name, StringType()) for name in PROMOTED]
)

ENTITY_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("name", StringType()),
        StructField("type", StringType()),
        StructField("properties", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

FACT_KEY = ("subject", "predicate", "object")
PROVENANCE = ("source_closet", "source_file", "source_drawer_id", "adapter_name")

TRIPLE_SCHEMA = StructType(
    [StructField("id", StringType())]
    + [StructField(name, StringType()) for name in FACT_KEY]
    + [
        StructField("valid_from", StringType()),
        StructField("valid_to", StringType()),
        StructField("confidence", DoubleType()),
    ]
    + [StructField(name, StringType()) for name in PROVENANCE]
    + [StructField("extracted_at", TimestampType())]
)

MANIFEST_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("status", StringType()),
        StructField("mtime", DoubleType()),
        StructField("drawers", LongType()),
        StructField("ts", TimestampType()),
    ]
)

QUARANTINE_SCHEMA = StructType(
    [
        StructField("ts", TimestampType()),
        StructField("table", StringType()),
        StructField("id", StringType()),
        StructField("source_file", StringType()),
        StructField("room", StringType()),
        StructField("error", StringType()),
        StructField("doc_preview", StringType()),
    ]
)

# The width limits of the stored columns, in characters.
WIDTH_LIMITS = {"id": 191, "wing": 255, "room": 255, "source_file": 512}
DEFAULT_DIM = 384
