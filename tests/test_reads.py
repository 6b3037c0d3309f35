import pytest
from loomstead.functions.metadata import with_promoted
from loomstead.operators import reads, reports
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def notes(spark):
    data = [
        ("a", "one", '{"wing":"w1","room":"r1","source_file":"f1"}', [1.0, 0.0]),
        ("b", "two", '{"wing":"w1","room":"unknown"}', [0.0, 1.0]),
        ("c", None, '{"wing":"w2"}', None),
        ("d", "four", "{}", [1.0, 1.0]),
    ]
    df = spark.createDataFrame(data, "id string, document string, metadata string, embedding array<float>")
    return with_promoted(df).cache()


def ids(df):
    return [r.id for r in df.orderBy("id").collect()]


def test_get_defaults(notes):
    assert reads.get(notes).columns == ["id", "document", "metadata"]
    assert ids(reads.get(notes, ids=[])) == ["a", "b", "c", "d"]  # an empty list is no condition


def test_ids_and_where_are_parenthesised(notes):
    found = reads.get(notes, ids=["a", "d"], where={"$or": [{"wing": "w1"}, {"wing": "w2"}]})
    assert ids(found) == ["a"]


def test_long_id_list_joins(notes, spark):
    wanted = ["a", "c"] + [f"x{i}" for i in range(1200)]
    assert ids(reads.get(notes, ids=wanted)) == ["a", "c"]
    assert ids(reads.get(notes, ids=spark.createDataFrame([("b",)], "id string"))) == ["b"]


@pytest.mark.parametrize(
    "include, columns",
    [
        (None, ["id", "document", "metadata"]),
        ([], ["id"]),
        (["metadatas"], ["id", "metadata"]),
        (["embeddings"], ["id", "embedding"]),
    ],
)
def test_include(notes, include, columns):
    assert reads.get(notes, include=include).columns == columns


def test_page(notes):
    assert ids(reads.get(notes, limit=2)) == ["a", "b"]
    assert ids(reads.get(notes, limit=2, offset=1)) == ["b", "c"]
    assert ids(reads.get(notes, offset=3)) == ["d"]
    assert ids(reads.get(notes, limit=0)) == []


@pytest.mark.parametrize("shallow", [0, 10])
@pytest.mark.parametrize("position, limit", [(0, 5), (57, 5), (123, None), (995, 50), (1000, 5), (5000, None)])
def test_large_and_deep_pages(spark, monkeypatch, shallow, position, limit):
    monkeypatch.setattr(reads, "SHALLOW_PAGE", shallow)
    numbered = spark.range(1000).select(F.concat(F.lit("row_"), F.col("id")).alias("id"))
    last = None if limit is None else position + limit
    expected = sorted(f"row_{i}" for i in range(1000))[position:last]
    assert ids(reads.page(numbered, limit, position)) == expected


def test_page_past_the_end(notes):
    one = notes.filter("id = 'a'")
    assert ids(reads.get(one, offset=1)) == [] and ids(reads.get(one, offset=0)) == ["a"]
    assert ids(reads.get(notes.filter("id = 'none'"), offset=1)) == []


def test_page_without_limit_stays_parallel(notes):
    plan = reads.get(notes, offset=2)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Limit" not in plan


def test_flat_result(notes):
    flat = reads.flat_result(reads.get(notes, limit=3)).first()
    assert flat.ids == ["a", "b", "c"]
    assert flat.documents == ["one", "two", None]
    empty = reads.flat_result(reads.get(notes, ids=["none"], limit=3)).first()
    assert empty.ids == []


def test_count(notes):
    assert reads.count(notes).first().n == 4


def test_count_by(notes):
    rooms = {r.room: r.n for r in reads.count_by(notes, "room").collect()}
    assert rooms == {"r1": 1, "unknown": 3}  # a real "unknown" and the missing ones add up
    wings = {r.wing: r.n for r in reads.count_by(notes, "wing", {"wing": "w1"}).collect()}
    assert wings == {"w1": 2}
    with pytest.raises(ValueError):
        reads.count_by(notes, "document")


def test_capacity(notes):
    row = reports.capacity_status(notes).first()
    assert (row.stored, row.searchable, row.divergence, row.diverged) == (4, 3, 1, True)
    whole = reports.capacity_status(notes.filter("embedding IS NOT NULL")).first()
    assert (whole.divergence, whole.diverged, whole.status) == (0, False, "ok")


def test_metadata_map(notes):
    row = reads.decoded_metadata(notes).filter("id = 'a'").first()
    assert row.metadata == {"wing": "w1", "room": "r1", "source_file": "f1"}


def test_ingest_status(rows):
    manifest = rows(
        "path string, status string, mtime double, drawers long, ts timestamp",
        ("a", "done", 1.0, 4, None), ("b", "pending", 1.0, None, None), ("c", "done", 1.0, 6, None),
    )
    row = reports.ingest_status(manifest, run_files=2, run_seconds=60).first()
    assert (row.done, row.total, row.pending, row.drawers) == (2, 3, 1, 10)
    assert row.files_per_minute == pytest.approx(2) and row.eta_hours == pytest.approx(30 / 3600)
