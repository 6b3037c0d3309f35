"""Dump tables to JSON lines and load them back.

A dump is a folder with one folder of JSON lines per table and a manifest. Vectors travel as
text, times as ISO text; the promoted columns are left out on loading and derived again.

The manifest keeps the number of rows and a checksum of each table, which the export observes as it
writes: the sum of the rows' hashes, so that the order of rows and files doesn't matter. A restore
observes both again as it loads and publishes the new snapshot only if they agree.
"""

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, BinaryType, DoubleType, FloatType, StringType, StructField, StructType

from ..functions.metadata import with_promoted
from ..functions.vectors import from_text, to_text
from ..schemas import PROMOTED
from .tables import write_snapshot

MANIFEST = "manifest"

# Spark's own JSON spelling of times stops at milliseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _vector_columns(schema: StructType) -> list[str]:
    return [
        f.name for f in schema
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, (FloatType, DoubleType))
    ]


def _binary_columns(schema):
    return [f.name for f in schema if isinstance(f.dataType, BinaryType)]


def export_rows(df: DataFrame) -> DataFrame:
    """The rows as they are dumped: vectors as text, bytes as UTF-8 with replacement."""
    changes = {c: to_text(c) for c in _vector_columns(df.schema)}
    changes |= {c: F.make_valid_utf8(F.col(c).cast("string")) for c in _binary_columns(df.schema)}
    return df.withColumns(changes) if changes else df


def manifest(tables: dict[str, DataFrame], created: str | None = None) -> DataFrame:
    """Per table: rows, columns, vector columns and the time given."""
    lines = [
        df.agg(F.count("*").alias("rows")).select(*_manifest_line(name, df.schema, F.col("rows"), created))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, lines)


def _manifest_line(name, schema, rows, created):
    def names(values):
        return F.array(*map(F.lit, values)).cast("array<string>")

    return [
        F.lit(name).alias("table"),
        rows.alias("rows"),
        names(schema.names).alias("columns"),
        names(_vector_columns(schema)).alias("vector_columns"),
        F.lit(created or datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%SZ")).alias("created"),
    ]


def _checked(schema: StructType) -> list[str]:
    """The columns a checksum covers, in a fixed order: those a dump gives back as they are. The
    promoted ones are derived on loading, and nested ones but vectors come back as text."""
    derived = PROMOTED if "metadata" in schema.names else ()
    nested = [f.name for f in schema if not isinstance(f.dataType, AtomicType) and f.name not in _vector_columns(schema)]
    return sorted(set(schema.names) - {*derived, *nested})


def _observed(rows: DataFrame, seen: Observation, checked: list[str]) -> DataFrame:
    """Rows as dumped, observed: their number and the sum of their hashes."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in checked]).cast("decimal(20,0)")
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row).alias("checksum"))


def export_tables(tables: dict[str, DataFrame], folder: str, created: str | None = None):
    """Dump every table, counting its rows as they are written, and the manifest last, so that
    a folder with a manifest is a complete dump."""
    if not tables:
        raise ValueError("no tables to dump")
    spark = next(iter(tables.values())).sparkSession
    lines = []
    for name, df in tables.items():
        seen = Observation()
        checked = _checked(df.schema)
        rows = _observed(export_rows(df), seen, checked)
        rows.write.options(**JSON_OPTIONS).json(f"{folder}/{name}")
        found = seen.get
        line = spark.range(1).select(*_manifest_line(name, df.schema, F.lit(found["rows"]).cast("long"), created))
        checksum = F.lit(None if found["checksum"] is None else str(found["checksum"])).cast("string")
        lines.append(line.select("*", F.array(*map(F.lit, checked)).cast("array<string>").alias("checked"), checksum.alias("checksum")))
    reduce(DataFrame.unionAll, lines).write.json(f"{folder}/{MANIFEST}")


def _lines(spark, folder, name, schema):
    def dumped_type(field):
        if isinstance(field.dataType, (ArrayType, BinaryType)):
            return StringType()
        return field.dataType

    stored = StructType([StructField(f.name, dumped_type(f)) for f in schema])
    # a line that is cut short fails the read instead of becoming a row of NULLs
    return spark.read.options(**JSON_OPTIONS, mode="FAILFAST").schema(stored).json(f"{folder}/{name}")


MANIFEST_COLUMNS = "`table` string, rows long, columns array<string>, vector_columns array<string>, created string"


def read_manifest(spark: SparkSession, folder: str, schema: str = MANIFEST_COLUMNS) -> DataFrame:
    return spark.read.schema(schema).json(f"{folder}/{MANIFEST}")


def load_dumped(spark: SparkSession, folder: str, table: str, schema: StructType) -> DataFrame:
    """The rows of one dumped table in ``schema``, promoted columns derived again."""
    return _loaded(_lines(spark, folder, table, _kept(schema)), schema)


def _kept(schema: StructType) -> StructType:
    derived = PROMOTED if "metadata" in schema.names else ()
    return StructType([f for f in schema if f.name not in derived])


def _loaded(rows: DataFrame, schema: StructType) -> DataFrame:
    kept = _kept(schema)
    derived = len(kept) < len(schema)
    changes = {c: from_text(c) for c in _vector_columns(kept)}
    changes |= {c: F.encode(c, "UTF-8") for c in _binary_columns(kept)}
    rows = rows.withColumns(changes) if changes else rows
    return (with_promoted(rows) if derived else rows).select(schema.names)


def dry_run(dumped: DataFrame, current: dict[str, DataFrame], table: str | None = None) -> DataFrame:
    """Rows in the dump (its manifest) against rows now, per table; changes nothing."""
    counts = reduce(
        DataFrame.unionAll,
        [df.agg(F.count("*").alias("current_rows")).select(F.lit(n).alias("table"), "current_rows")
         for n, df in current.items()],
    )
    both = dumped.select("table", F.col("rows").alias("backup_rows")).join(counts, "table", "full_outer")
    return both if table is None else both.filter(F.col("table") == table)


def restore(
    spark: SparkSession, folder: str, schemas: dict[str, StructType], roots: dict[str, str], table=None
) -> dict[str, int]:
    """Load every dumped table (or one) into a new snapshot below its root. The snapshot before
    it stays until the new one is complete.

    A table whose rows or checksum differ from the manifest raises ValueError and leaves no
    snapshot; manifests without a checksum, and schemas without all the columns it covers, are checked
    by rows alone. Tables restored before the one that fails stay restored.
    """
    listed = read_manifest(spark, folder, f"{MANIFEST_COLUMNS}, checked array<string>, checksum string").collect()
    lines = {r["table"]: r for r in listed}
    chosen = [name for name in schemas if name in lines and table in (None, name)]
    return {name: _restored(spark, folder, lines[name], schemas[name], roots[name]) for name in chosen}


def _restored(spark: SparkSession, folder: str, line, schema: StructType, root: str) -> int:
    seen, checked = Observation(), line["checked"] or []
    covered = bool(checked) and set(checked) <= set(_kept(schema).names)
    rows = _observed(_lines(spark, folder, line["table"], _kept(schema)), seen, checked if covered else _checked(schema)[:1])

    def check():
        found = seen.get
        if found["rows"] != line["rows"]:
            raise ValueError(f"{line['table']}: {found['rows']} rows in the dump, {line['rows']} in its manifest")
        if covered and str(found["checksum"]) != str(line["checksum"]):
            raise ValueError(f"{line['table']}: the rows of the dump are not those its manifest was made from")

    return write_snapshot(_loaded(rows, schema), root, check=check)
