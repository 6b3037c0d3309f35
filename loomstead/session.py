"""Session settings the operators count on, and the shared scratch folder."""

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins here put a side that is unique on the key against one that may be very skewed, which
# is the case the adaptive skew join splits. "force" lets it split even where that costs an
# extra exchange later.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; sizes and partition counts stay the cluster's own."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="loomstead-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder on storage every executor sees, below ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join rows, any number of which may share a key, to a frame with one row per key.

    The adaptive skew join splits a hot key only between two exchanges of the join's own. An
    aggregate on the same keys would lend the join its partitioning and so prevent that; with
    a hash as one more key it does not, at the price of moving one row per key again.
    """
    hashed = [df.selectExpr("*", f"xxhash64({', '.join(keys)}) AS _hash") for df in (rows, per_key)]
    return hashed[0].join(hashed[1], ["_hash", *keys], how).drop("_hash")


def nothing(spark: SparkSession, schema) -> DataFrame:
    """An empty frame the optimizer knows to be empty, so that work on it is planned away."""
    return spark.createDataFrame([], schema).filter(F.lit(False))


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so that a lost executor
    costs a re-read and a plan used several times is computed once."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
