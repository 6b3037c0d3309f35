"""What the operators of this package share: tables, cut points, byte-level text helpers."""

import ctypes
import functools
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.session import tune

#: Rows per Arrow batch; texts are long, so batches are kept short.
BATCH_ROWS = 1024

#: The bytes a word never holds (space and \t \n \v \f \r), as ``bytes.split()`` has them.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def prepared(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="loomstead-llm-")


def new_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor sees.

    Where that is unset, only a session on this one machine (as in tests) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: The folders that ``cut`` has written, in order.
WRITTEN: list[str] = []


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders whose frames are no longer needed."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is computed once, and a lost
    executor costs a re-read. The file size also tells Spark which joins it may broadcast."""
    path = new_folder(df.sparkSession)
    WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def word_counts(batch: pa.RecordBatch, name: str = "text") -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text of a batch, in one pass over its bytes."""
    texts = texts_of(batch, name)
    ends = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = IS_SPACE[data]
    ended = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    upto = np.searchsorted(ended, ends, "left")
    return np.diff(upto, prepend=0).astype(np.int64)


def null_safe_key(*names: str):
    """Columns as one JSON text, so that null is a key like any other."""
    return F.to_json(F.struct(*[F.col(x) for x in names]))


def hand_back() -> None:
    """Give memory that is no longer used back to the system (where its C library can)."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run):
    """A task's function of batches that hands back its memory when it ends. Workers serve one
    task after the other, and idle ones would hold about the most that any task took."""

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()

    return task


def with_columns(df: DataFrame, added: str, of_batch, *inputs: str) -> DataFrame:
    """Append columns that a function of Arrow batches computes; all columns given are kept.

    ``added`` is a DDL list whose names must be new; ``of_batch`` gets each batch and returns
    a dict of arrays.
    """
    names = [x.split()[0] for x in added.split(", ")]
    columns = list(inputs) or df.columns
    rows = df.select(*columns)

    def run(batches):
        for batch in batches:
            new = of_batch(batch)
            arrays = [*batch.columns, *[pa.array(new[n]) if not isinstance(new[n], pa.Array) else new[n] for n in names]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *names])

    schema = rows.limit(0).selectExpr("*", *[f"CAST(NULL AS {x.split(' ', 1)[1]}) AS {x.split()[0]}" for x in added.split(", ")]).schema
    return rows.mapInArrow(tidy(run), schema)
