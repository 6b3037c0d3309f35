import json

import pytest
from loomstead.operators import reports
from loomstead.operators.embedding import HashedTextEmbedder
from loomstead.operators.fact_events import apply_events
from loomstead.schemas import COLLECTION_SCHEMA, ENTITY_SCHEMA, TRIPLE_SCHEMA
from loomstead.sources import tables
from loomstead.streaming import fact_stream, ingest


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(line) + "\n" for line in lines))


def line(id, document, metadata="{}", **more):
    return {"id": id, "document": document, "metadata": metadata, **more}


def stored(spark, store):
    return {r.id: r for r in ingest.stored_rows(spark, store).collect()}


def test_ingest_resumes(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    run = dict(dim=16, embedder=HashedTextEmbedder(16), defaults={"wing": 'the "wing"'})
    put(source, "one.jsonl", line("a", "first"), line("b", "second", '{"wing":"own"}'), line("bad", "x", "not json"))
    assert ingest.ingest(spark, str(source), store, **run) == 1
    rows = stored(spark, store)
    assert set(rows) == {"a", "b"}
    assert (rows["a"].wing, rows["b"].wing, rows["a"].metadata) == ('the "wing"', "own", '{"wing":"the \\"wing\\""}')
    assert rows["a"].embedding is not None
    assert ingest.ingest(spark, str(source), store, **run) == 0  # nothing new

    put(source / "deep", "two.jsonl", line("a", "again"), line("a", "last"), line("c", "third", line=2), line("c", "early", line=1))
    assert ingest.ingest(spark, str(source), store, **run) == 1
    rows = stored(spark, store)
    assert set(rows) == {"a", "b", "c"} and rows["a"].document == "last" and rows["c"].document == "third"
    assert [r.id for r in ingest.quarantined(spark, store).collect()] == ["bad"]
    done = {r.path.rsplit("/", 1)[1]: r.drawers for r in ingest.manifest(spark, store).collect()}
    assert done == {"one.jsonl": 2, "two.jsonl": 2}
    status = reports.ingest_status(ingest.manifest(spark, store)).first()
    assert (status.done, status.pending, status.drawers) == (2, 0, 4)
    assert ingest.compact(spark, store, str(tmp_path / "snap")) == 0
    assert tables.read_snapshot(spark, str(tmp_path / "snap"), COLLECTION_SCHEMA)[1].count() == 3


def test_ingest_limit(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    for i in range(5):
        put(source, f"f{i}.jsonl", line(f"id{i}", "text"))
    counts = []
    for _ in range(4):
        ingest.ingest(spark, str(source), store, dim=4, files_per_batch=2, limit=2)
        counts.append(len(stored(spark, store)))
    assert counts == [2, 4, 5, 5]


def test_ingest_failure_leaves_the_batch_pending(spark, tmp_path):
    class Broken:
        dim = 4

        def embed(self, texts):
            raise RuntimeError("model is down")

    source, store = tmp_path / "in", str(tmp_path / "store")
    put(source, "one.jsonl", line("a", "text"))
    from pyspark.cloudpickle import register_pickle_by_value
    import sys

    register_pickle_by_value(sys.modules[__name__])
    with pytest.raises(Exception, match="model is down"):
        ingest.ingest(spark, str(source), store, dim=4, embedder=Broken())
    assert ingest.ingest(spark, str(source), store, dim=4, embedder=HashedTextEmbedder(4)) == 1
    assert set(stored(spark, store)) == {"a"}


def event(seq, kind, subject="Ida", **more):
    return {"seq": seq, "kind": kind, "subject": subject, "predicate": "plays", "object": "Cello", **more}


def test_fact_stream(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    put(source, "1.json", event(1, "add", valid_from="2025-01-01"), event(2, "add"), event(3, "end", ended="2024-01-01"))
    fact_stream.run_events(spark, str(source), store)
    put(source, "2.json", event(4, "end", ended="2025-06-01"), event(5, "add", valid_from="2025-07-01"), event(6, "add", "Ann"))
    fact_stream.run_events(spark, str(source), store)
    status = {r.seq: r.status for r in fact_stream.outcomes(spark, store).collect()}
    assert status == {1: "inserted", 2: "existing", 3: "rejected", 4: "closed", 5: "inserted", 6: "inserted"}
    facts = sorted((r.subject, r.valid_from or "", r.valid_to or "") for r in fact_stream.facts(spark, store).collect())
    assert facts == [("ann", "", ""), ("ida", "2025-01-01", "2025-06-01"), ("ida", "2025-07-01", "")]
    assert {r.id for r in fact_stream.entities(spark, store).collect()} == {"ida", "ann", "cello"}

    before = sorted(r.id for r in fact_stream.facts(spark, store).collect())
    events = spark.read.schema(fact_stream.EVENT_SCHEMA).json(str(source / "2.json"))
    fact_stream.apply_batch(spark, store, events, 1)  # repeating a batch changes nothing
    assert sorted(r.id for r in fact_stream.facts(spark, store).collect()) == before


@pytest.mark.parametrize("compacted", [2, 100])
def test_a_batch_writes_what_it_changes(spark, tmp_path, monkeypatch, compacted):
    """Many batches against one application of all events; each is repeated once, as after a
    failure; the folders of a batch hold its own changes only."""
    monkeypatch.setattr(fact_stream, "COMPACTED", compacted)
    store = str(tmp_path / "store")
    batches = [
        [event(1, "add", valid_from="2025-01-01"), event(2, "add", "Ann")],
        [event(3, "end", ended="2024-01-01"), event(4, "end", "Ann", ended="2025-02-01"), event(5, "add", "Bo")],
        [event(6, "end", ended="2025-06-01"), event(7, "add", valid_from="2025-07-01"), event(8, "add", "Bo")],
        [event(9, "end", "Bo", ended="2025-06-01"), event(10, "add", "Ann", valid_from="2025-03-01")],
        [event(11, "end", "Cy", ended="2025-06-01")],
    ]
    for number, batch in enumerate(batches):
        events = spark.createDataFrame([{"valid_from": None, "ended": None, **e} for e in batch], fact_stream.EVENT_SCHEMA)
        for _ in range(2):
            fact_stream.apply_batch(spark, store, events, number)
    every = spark.createDataFrame([{"valid_from": None, "ended": None, **e} for b in batches for e in b], fact_stream.EVENT_SCHEMA)
    nobody, nothing_yet = (spark.createDataFrame([], s) for s in (ENTITY_SCHEMA, TRIPLE_SCHEMA))
    whole = apply_events(nobody, nothing_yet, every, "2026-01-01", id_salt="stream")
    shown = ("id", "subject", "valid_from", "valid_to")
    assert sorted(map(str, fact_stream.facts(spark, store).select(*shown).collect())) == sorted(map(str, whole.triples.select(*shown).collect()))
    assert sorted(map(str, fact_stream.outcomes(spark, store).collect())) == sorted(map(str, whole.outcomes.collect()))
    assert {r.id for r in fact_stream.entities(spark, store).collect()} == {r.id for r in whole.entities.collect()}
    changed = [sum(spark.read.parquet(f"{store}/{name}/v={n:010d}").count() for name in ("opened", "ended", "finished", "entities")) for n in range(5)]
    assert changed == [5, 4, 3, 3, 0]
    if compacted == 2:
        buckets = fact_stream.open_facts(spark, store, 5, [3])._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in buckets and "bucket" in buckets
