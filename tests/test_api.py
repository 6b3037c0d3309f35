import json

import pytest
from loomstead import Collection, FactGraph, jobs
from loomstead.operators.embedding import HashedTextEmbedder
from loomstead.schemas import COLLECTION_SCHEMA, ENTITY_SCHEMA, TRIPLE_SCHEMA
from loomstead.sources import tables
from loomstead.streaming import ingest


def test_collection(spark):
    c = Collection.empty(spark, dim=8, embedder=HashedTextEmbedder(8))
    c = c.add(ids=["a", "b", "a"], documents=["red apple", None, "green pear"], metadatas=[{"wing": "x"}, None, {"wing": "y"}])
    assert c.count() == 2 and c.skipped.count() == 0
    assert c.get(ids=["a"]).first().document == "green pear"
    c = c.update(ids=["b"], documents=["blue sea"])
    hits = c.query(query_texts=["blue sea", "green pear"], n_results=1).orderBy("query_id").collect()
    assert [r.id for r in hits] == ["b", "a"] and abs(hits[0].distance) < 1e-6
    assert c.query(query_embeddings=[[0.0, 0, 0, 0, 0, 0, 0, 1]], n_results=5).count() == 2
    assert c.query().count() == 0
    assert {r.wing: r.n for r in c.count_by("wing").collect()} == {"y": 1, "unknown": 1}
    assert c.capacity_status().first().diverged is False
    assert c.upsert(ids=[], documents=[]).count() == 2
    assert c.upsert(ids=["v"], embeddings=[[1.0]]).skipped.first().id == "v"
    assert c.delete(where={"wing": "y"}).count() == 1 and c.count() == 2


def test_fact_graph(spark):
    g = FactGraph.empty(spark).add_entity("Ida Brook", "person", {"gender": "m"})
    g = g.add_triple("Ida Brook", "plays", "cello", valid_from="2025-11-07", confidence=0.5)
    assert g.query_entity("Ida Brook", as_of="2026-03-09").first().confidence == 0.5
    assert g.add_triple("ida brook", "PLAYS", "Cello").outcomes.first().status == "existing"
    refused = g.invalidate("Ida Brook", "plays", "cello", ended="2025-01-01")
    assert refused.outcomes.count() == 1 and refused.current_facts().count() == 1
    done = g.invalidate("Ida Brook", "plays", "cello", ended="2026-08-21")
    assert done.timeline("Ida Brook").first().valid_to == "2026-08-21"
    assert done.stats().first().expired_facts == 1
    seeded = g.seed_from_entity_facts({"rex": {"relationship": "dog", "owner": "ida", "interests": ["bones"]}})
    assert [r.predicate for r in seeded.relationship_types().collect()] == ["is_pet_of", "loves", "plays"]
    assert seeded.query_relationship("is pet of").first().object == "Ida"


@pytest.fixture()
def keep_session(spark, monkeypatch):
    monkeypatch.setattr(jobs.SparkSession, "builder", type("B", (), {
        "appName": lambda self, name: self, "getOrCreate": lambda self: spark})())


def test_backup_and_restore_jobs(spark, tmp_path, keep_session, capsys):
    root, out = str(tmp_path / "db"), str(tmp_path / "dump")
    c = Collection.empty(spark, dim=2).add(ids=["a", "b"], embeddings=[[1.0, 0.5], None], metadatas=[{"wing": "x"}, {}])
    g = FactGraph.empty(spark).add_triple("A", "knows", "B", valid_from="2025-01-01")
    for name, df in {"notes": c.rows, "entities": g.entities, "triples": g.triples}.items():
        tables.write_snapshot(df, f"{root}/{name}")
    jobs.main(["backup", root, out])
    jobs.main(["restore", out, root])
    assert "dry run" in capsys.readouterr().out and tables.versions(spark, f"{root}/notes") == [0]
    jobs.main(["restore", out, root, "--apply"])
    for name, schema in {"notes": COLLECTION_SCHEMA, "entities": ENTITY_SCHEMA, "triples": TRIPLE_SCHEMA}.items():
        version, now = tables.read_snapshot(spark, f"{root}/{name}", schema)
        _, before = tables.read_snapshot(spark, f"{root}/{name}", schema, before=1)
        assert version == 1 and now.exceptAll(before).count() == 0 and before.exceptAll(now).count() == 0


def test_ingest_job(spark, tmp_path, keep_session, capsys):
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    for i in range(3):
        (source / f"{i}.jsonl").write_text(json.dumps({"id": f"i{i}", "document": "text", "metadata": "{}"}) + "\n")
    common = ["ingest", str(source), store, "--dim", "8", "--wing", "w"]
    jobs.main([*common, "--status"])
    jobs.main([*common, "--limit", "1", "--batch", "1"])
    status = {r.status: r.n for r in ingest.progress(spark, str(source), store).groupBy("status").count().withColumnRenamed("count", "n").collect()}
    assert status == {"done": 1, "pending": 2}
    jobs.main(common)
    assert {r.wing for r in ingest.stored_rows(spark, store).collect()} == {"w"}
    assert ingest.stored_rows(spark, store).count() == 3
    assert "eta_hours" in capsys.readouterr().out
