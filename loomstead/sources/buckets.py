"""Tables kept in buckets of ids, of which a write replaces only those it touches.

A version is a folder with the buckets it wrote and a map that names, for every bucket, the
version that holds it. The map is written last, so a failed write leaves the version before it
in place; of two writers of the same version the second fails.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import nothing
from .tables import SNAPSHOT, _filesystem, versions

MAP = "bucket int, version int, buckets int"


def bucket_of(buckets: int, key: str = "id"):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _state(spark, root):
    """(version, number of buckets, {bucket: version that holds it})."""
    known = versions(spark, f"{root}/maps")
    if not known:
        raise ValueError(f"{root} holds no table in buckets")
    rows = spark.read.schema(MAP).parquet(f"{root}/maps/{SNAPSHOT.format(known[-1])}").collect()
    return known[-1], rows[0]["buckets"], {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}


def _write(rows: DataFrame, root: str, version: int, buckets: int, others: dict[int, int], touched: int) -> int:
    spark, folder = rows.sparkSession, f"{root}/rows/{SNAPSHOT.format(version)}"
    dealt = rows.withColumn("_bucket", bucket_of(buckets)).repartition(max(touched, 1), "_bucket")
    dealt.write.mode("overwrite").partitionBy("_bucket").parquet(folder)
    fs, path = _filesystem(spark, folder)
    names = [e.getPath().getName() for e in fs.listStatus(path)]
    held = others | {int(n.split("=")[1]): version for n in names if n.startswith("_bucket=")}
    # The row without a bucket keeps the number of buckets of an empty table.
    entries = [(None, None, buckets), *[(b, v, buckets) for b, v in sorted(held.items())]]
    spark.createDataFrame(entries, MAP).coalesce(1).write.parquet(f"{root}/maps/{SNAPSHOT.format(version)}")
    return version


def create(df: DataFrame, root: str, buckets: int) -> int:
    """Store a table in ``buckets`` buckets of its ``id``."""
    return _write(df, root, 0, buckets, {}, buckets)


def read(spark: SparkSession, root: str, schema, only=None) -> DataFrame:
    """The table as it stands, or only some of its buckets."""
    _, _, held = _state(spark, root)
    paths = [
        f"{root}/rows/{SNAPSHOT.format(v)}/_bucket={b}" for b, v in sorted(held.items()) if only is None or b in only
    ]
    return spark.read.schema(schema).parquet(*paths) if paths else nothing(spark, schema)


def rewrite(
    spark: SparkSession, root: str, schema, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]
) -> int:
    """Replace the buckets in which ``batch`` has ids by ``change(rows of these buckets, batch)``, such
    as an upsert, an update or a deletion; the others are neither read nor written. Returns the
    new version."""
    version, buckets, held = _state(spark, root)
    touched = {r[0] for r in batch.select(bucket_of(buckets)).distinct().collect()}
    rows = change(read(spark, root, schema, touched), batch)
    others = {b: v for b, v in held.items() if b not in touched}
    return _write(rows, root, version + 1, buckets, others, len(touched))
