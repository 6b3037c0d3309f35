"""Stored forms: sorted snapshots and their pages, tables in buckets, Bloom filters, lines kept whole."""

import os

import pytest
from loomstead.operators import writes
from loomstead.schemas import COLLECTION_SCHEMA
from loomstead.sources import buckets, tables
from loomstead.streaming import ingest
from pyspark.sql import functions as F


def numbered(spark, n, copies=1):
    return spark.range(n * copies, numPartitions=5).select(
        F.format_string("row_%05d", (F.col("id") * 7919) % n).alias("id"), F.lit("x").alias("document")
    )


@pytest.fixture(scope="module")
def sorted_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sorted"))
    tables.write_sorted(numbered(spark, 1000, copies=2), root, range_rows=90)  # every id twice
    return root


@pytest.mark.parametrize("limit, offset", [(5, 0), (200, 333), (1, 1999), (None, 1950), (10, 1995), (0, 4), (5, 2000)])
def test_pages_of_a_sorted_snapshot(spark, sorted_root, limit, offset):
    everything = sorted([f"row_{i:05d}" for i in range(1000)] * 2)
    page = tables.read_page(spark, sorted_root, "id string, document string", limit, offset)
    assert [r.id for r in page.collect()] == everything[offset : None if limit is None else offset + limit]


def test_a_page_opens_its_own_files_only(spark, sorted_root):
    page = tables.read_page(spark, sorted_root, "id string, document string", 100, 900)
    files = len(os.listdir(f"{sorted_root}/{tables.SNAPSHOT.format(0)}"))
    assert len(page.inputFiles()) <= 4 < files / 4  # with the one of the index
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "SinglePartition" not in plan


def entries(spark, ids, text):
    return spark.createDataFrame([(i, text) for i in ids], "id string, document string")


def folders(root, version):
    return {n for n in os.listdir(f"{root}/rows/{tables.SNAPSHOT.format(version)}") if n.startswith("_bucket=")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    all_ids = [f"n{i}" for i in range(300)]
    first = writes.upsert(spark.createDataFrame([], COLLECTION_SCHEMA), entries(spark, all_ids, "old"))
    assert buckets.create(first, root, 32) == 0
    batch = entries(spark, ["n3", "n4", "new"], "new")
    assert buckets.rewrite(spark, root, COLLECTION_SCHEMA, batch, writes.upsert) == 1
    touched = {f"_bucket={r[0]}" for r in batch.select(buckets.bucket_of(32)).collect()}
    assert folders(root, 1) == touched and len(touched) <= 3 < len(folders(root, 0))
    found = {r.id: r.document for r in buckets.read(spark, root, COLLECTION_SCHEMA).collect()}
    assert found == {i: "old" for i in all_ids} | {"n3": "new", "n4": "new", "new": "new"}

    # Deleting every row of a bucket leaves it without files.
    own = spark.createDataFrame([(i,) for i in found], "id string").filter(buckets.bucket_of(32) == 5)
    assert buckets.rewrite(spark, root, COLLECTION_SCHEMA, own, writes.delete) == 2
    gone = {r.id for r in own.collect()}
    assert gone and {r.id for r in buckets.read(spark, root, COLLECTION_SCHEMA).collect()} == set(found) - gone
    assert buckets.rewrite(spark, root, COLLECTION_SCHEMA, own.limit(0), writes.delete) == 3  # nothing to do
    assert buckets.read(spark, root, COLLECTION_SCHEMA).count() == len(found) - len(gone)


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.create(writes.upsert(spark.createDataFrame([], COLLECTION_SCHEMA), entries(spark, ["a", "b"], "old")), root, 4)

    def broken(rows, batch):
        return rows.withColumn("document", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        buckets.rewrite(spark, root, COLLECTION_SCHEMA, entries(spark, ["a"], "new"), broken)
    assert {r.document for r in buckets.read(spark, root, COLLECTION_SCHEMA).collect()} == {"old"}
    assert buckets.rewrite(spark, root, COLLECTION_SCHEMA, entries(spark, ["a"], "new"), writes.upsert) == 1
    assert buckets.read(spark, root, COLLECTION_SCHEMA).filter("document = 'new'").count() == 1


def test_a_table_without_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.create(spark.createDataFrame([], COLLECTION_SCHEMA), root, 4)
    assert buckets.read(spark, root, COLLECTION_SCHEMA).count() == 0
    buckets.rewrite(spark, root, COLLECTION_SCHEMA, entries(spark, ["a"], "new"), writes.upsert)
    assert [r.id for r in buckets.read(spark, root, COLLECTION_SCHEMA).collect()] == ["a"]


def rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    """Ids in no order, without a dictionary: only the Bloom filters can tell the row groups apart."""
    rows = spark.range(60_000, numPartitions=1).selectExpr("concat('n', xxhash64(id)) AS id", "id AS n")
    small = {"parquet.block.size": "65536", "parquet.enable.dictionary": "false",
             "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"}
    wanted = rows.filter("n = 31415").first()["id"]
    scanned = {}
    for name, options in {"plain": {}, "bloom": tables.lookup_options("id", distinct=5_000)}.items():
        tables.write_snapshot(rows, str(tmp_path / name), **small, **options)
        found = tables.read_snapshot(spark, str(tmp_path / name), rows.schema)[1].filter(F.col("id") == wanted)
        assert [r["n"] for r in found.collect()] == [31415]
        scanned[name] = rows_scanned(found)
    assert scanned["bloom"] < scanned["plain"] / 4


def test_unreadable_lines_are_kept_whole(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    long = '{"id":"cut","document":"' + "x" * 500
    odd = '{"id":"odd","document":"y","embedding":7}'
    (source / "a.jsonl").write_text("\n".join(['{"id":"a","document":"fine"}', long, "", odd, "null", '{"document":"no id"}']) + "\n")
    assert ingest.ingest(spark, str(source), store, dim=4) == 1
    assert [r.id for r in ingest.stored_rows(spark, store).collect()] == ["a"]
    assert {r.raw for r in ingest.unreadable(spark, store).collect()} == {long, odd, "null"}
    bad = {(r.error, r.doc_preview) for r in ingest.quarantined(spark, store).collect()}
    assert bad == {
        (ingest.UNREADABLE, long[:200]), (ingest.UNREADABLE, odd), (ingest.UNREADABLE, "null"), ("id is missing", "no id"),
    }


class Failing:
    """Works for one text, then no more."""

    dim = 4

    def embed(self, texts):
        if any(t == "second" for t in texts):
            raise RuntimeError("model is down")
        return [[1.0, 0, 0, 0] for _ in texts]


def test_only_the_limit_ends_a_run_in_silence(spark, tmp_path):
    import sys

    from pyspark.cloudpickle import register_pickle_by_value

    register_pickle_by_value(sys.modules[__name__])
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    (source / "1.jsonl").write_text('{"id":"a","document":"first"}\n{"id":"b","document":"second"}\n')
    with pytest.raises(Exception, match="model is down"):
        ingest.ingest(spark, str(source), store, dim=4, embedder=Failing(), limit=1)
