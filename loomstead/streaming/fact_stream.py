"""A stream of fact events (adds and endings) applied in order.

What a micro-batch writes follows the batch and not the store. Batch n appends folders numbered
n: the facts it opened, the ids of open facts it ended, the facts that are finished, the
entities it was the first to name. The open facts are those of the newest base, which is
written every ``COMPACTED`` batches, with what was opened and without what was ended since. The
base lies in buckets of the fact key, so a batch reads only the buckets of its own keys.

Batch n reads folders numbered below n and writes those numbered n, its outcomes last. So
repeating a batch gives the same result, and readers see a batch when its outcomes are there.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fact_events import CHUNK_SPAN, changes, judged_events, with_endings
from ..operators.fact_writes import KEY, keyed, mentioned
from ..schemas import ENTITY_SCHEMA, TRIPLE_SCHEMA
from ..session import nothing, written
from ..sources.tables import SNAPSHOT, read_snapshot, versions

EVENT_SCHEMA = (
    "seq long, kind string, subject string, predicate string, object string, valid_from string, "
    "valid_to string, ended string, confidence double, source_closet string, source_file string, "
    "source_drawer_id string, adapter_name string"
)
OUTCOME_SCHEMA = "seq long, kind string, status string, fact_id string, reason string"
BUCKETS = 64
COMPACTED = 16

def _bucket():
    return F.expr(f"CAST(pmod(xxhash64({', '.join(KEY)}), {BUCKETS}) AS INT)")


def _next(spark: SparkSession, store: str) -> int:
    """The number after the last batch that is complete."""
    return max(versions(spark, f"{store}/outcomes"), default=-1) + 1


def _log(spark: SparkSession, store: str, name: str, schema, after: int, before: int) -> DataFrame:
    """The folders of a log numbered above ``after`` and below ``before``."""
    found = [v for v in versions(spark, f"{store}/{name}") if after < v < before]
    if not found:
        return nothing(spark, schema)
    return spark.read.schema(schema).parquet(*[f"{store}/{name}/{SNAPSHOT.format(v)}" for v in found])


def open_facts(spark: SparkSession, store: str, before: int, buckets: list[int] | None = None) -> DataFrame:
    """The facts open after all batches numbered below ``before``, of some buckets or of all."""
    wide = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in TRIPLE_SCHEMA)}, bucket int"
    base, rows = read_snapshot(spark, f"{store}/open", wide, before=before)
    base = -1 if base is None else base
    opened = _log(spark, store, "opened", TRIPLE_SCHEMA, base, before).withColumn("bucket", _bucket())
    ended = _log(spark, store, "ended", "id string", base, before)
    rows = rows.unionByName(opened)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return rows.join(ended, "id", "left_anti").select(TRIPLE_SCHEMA.names)


def apply_batch(spark: SparkSession, store: str, events: DataFrame, number: int, span: int = CHUNK_SPAN):
    """Apply one micro-batch to the store."""
    events = written(events)
    # at most BUCKETS numbers
    buckets = [r.bucket for r in keyed(events).select(_bucket().alias("bucket")).distinct().collect() if r.bucket is not None]
    still_open = open_facts(spark, store, number, buckets)
    now = datetime.now(timezone.utc).isoformat()

    def append(rows: DataFrame, name: str):
        rows.write.mode("overwrite").parquet(f"{store}/{name}/{SNAPSHOT.format(number)}")

    # seq is unique over the whole stream, so ids need nothing of the clock and survive a repeat
    judgement = written(judged_events(still_open, events, "stream", span))
    new, ended = changes(still_open, judgement, now)
    new, closed = written(new), written(with_endings(still_open, ended, "inner"))
    added = judgement.filter("kind = 'add' AND status IN ('inserted', 'existing')")
    known = _log(spark, store, "entities", ENTITY_SCHEMA, -1, number)
    append(mentioned(added, now).join(known.select("id"), "id", "left_anti").select(ENTITY_SCHEMA.names), "entities")
    append(new.filter("valid_to IS NULL"), "opened")
    append(closed.select("id"), "ended")
    append(closed.unionByName(new.filter("valid_to IS NOT NULL")), "finished")
    if number % COMPACTED == COMPACTED - 1:
        base = open_facts(spark, store, number + 1).withColumn("bucket", _bucket())
        written(base).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/open/{SNAPSHOT.format(number)}")
    append(judgement.select("seq", "kind", "status", "fact_id", "reason"), "outcomes")


def run_events(
    spark: SparkSession, source: str, store: str, files_per_batch: int = 50, span: int = CHUNK_SPAN
):
    """Apply all new event files (JSON lines) below ``source``, then stop."""
    events = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
    )
    run = (
        events.writeStream.foreachBatch(lambda df, number: apply_batch(spark, store, df, number, span))
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def facts(spark: SparkSession, store: str) -> DataFrame:
    """Every fact: the open ones and the log of finished ones."""
    end = _next(spark, store)
    return open_facts(spark, store, end).unionByName(_log(spark, store, "finished", TRIPLE_SCHEMA, -1, end))


def entities(spark: SparkSession, store: str) -> DataFrame:
    return _log(spark, store, "entities", ENTITY_SCHEMA, -1, _next(spark, store))


def outcomes(spark: SparkSession, store: str) -> DataFrame:
    return _log(spark, store, "outcomes", OUTCOME_SCHEMA, -1, _next(spark, store))
