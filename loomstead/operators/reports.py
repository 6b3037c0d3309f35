"""Small reports over whole tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def capacity_status(collection: DataFrame) -> DataFrame:
    """Stored rows against rows a search can reach. Search scans every vector, so the only
    rows out of reach are those without one."""
    sizes = collection.agg(F.count("*").alias("stored"), F.count("embedding").alias("searchable"))
    gap = F.col("stored") - F.col("searchable")
    return sizes.select(
        "stored",
        "searchable",
        gap.alias("divergence"),
        (gap > 0).alias("diverged"),
        F.when(gap > 0, "rows without a vector").otherwise("ok").alias("status"),
    )


def collection_inventory(collections: dict[str, DataFrame]) -> DataFrame:
    """Name, rows and rows with a vector, per collection."""
    sizes = [
        df.agg(F.count("*").alias("n"), F.count("embedding").alias("embedded")).select(
            F.lit(name).alias("name"), "n", "embedded"
        )
        for name, df in collections.items()
    ]
    return reduce(DataFrame.unionAll, sizes)


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("table").agg(F.count("*").alias("skipped"))


def remine_candidates(quarantine: DataFrame, collection: DataFrame) -> DataFrame:
    """Quarantined ids that have not been stored since, with where they came from."""
    seen = quarantine.groupBy("id").agg(
        F.max("source_file").alias("source_file"), F.max("room").alias("room"), F.count("*").alias("attempts")
    )
    return seen.join(collection.select("id"), "id", "left_anti")


def already_mined(files: DataFrame, collection: DataFrame, how: str = "left_semi") -> DataFrame:
    """Files (``source_file``) with rows in the collection, or with ``left_anti`` those without."""
    mined = collection.select("source_file").distinct()
    return files.join(mined, "source_file", how)


def ingest_status(manifest: DataFrame, run_files: int = 0, run_seconds: float = 0.0) -> DataFrame:
    """Progress of an ingest: files done, total and pending, rows filed, and from the files
    finished in ``run_seconds`` of the current run its rate and the hours left."""
    done = F.col("status") == "done"
    rate = run_files / max(run_seconds, 1.0)
    totals = manifest.agg(
        F.count_if(done).alias("done"),
        F.count("*").alias("total"),
        F.coalesce(F.sum(F.when(done, F.col("drawers"))), F.lit(0)).alias("drawers"),
    )
    pending = F.col("total") - F.col("done")
    hours = pending / F.lit(rate) / 3600 if rate else F.lit(0.0)
    return totals.select(
        "done",
        "total",
        pending.alias("pending"),
        "drawers",
        F.lit(rate * 60).alias("files_per_minute"),
        hours.alias("eta_hours"),
    )
