"""Call-style access: a collection and a fact graph as objects over their frames.

Nothing is changed in place. A write returns a new object holding the next state as a plan;
write its frames to a new snapshot (see ``sources.tables``) to keep it.
"""

import json
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .operators import fact_events, fact_reads, fact_writes, reads, reports, search, seeding, writes
from .operators.embedding import Embedder, embed_where_missing
from .schemas import COLLECTION_SCHEMA, DEFAULT_DIM, ENTITY_SCHEMA, PROVENANCE, TRIPLE_SCHEMA, VECTOR
from .session import nothing


def batch_of(
    spark: SparkSession, ids, documents=None, metadatas=None, embeddings=None
) -> DataFrame:
    """Parallel lists as a batch in list order; lists that are not given leave no column."""
    ids = list(ids)
    columns = {"id string": ids, "seq long": range(len(ids))}
    if documents is not None:
        columns["document string"] = documents
    if metadatas is not None:
        columns["metadata string"] = [json.dumps(m or {}) for m in metadatas]
    if embeddings is not None:
        columns[f"embedding {VECTOR.simpleString()}"] = [
            None if v is None else [float(x) for x in v] for v in embeddings
        ]
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(columns))


@dataclass(frozen=True)
class Collection:
    """Documents with metadata and vectors. ``skipped`` holds what the last write left out."""

    rows: DataFrame
    dim: int = DEFAULT_DIM
    embedder: Embedder | None = None
    name: str = "collection"
    metadata: dict = field(default_factory=dict)
    skipped: DataFrame | None = None

    @classmethod
    def empty(cls, spark: SparkSession, **options) -> "Collection":
        return cls(nothing(spark, COLLECTION_SCHEMA), **options)

    def _batch(self, ids, *lists):
        if isinstance(ids, DataFrame):
            return ids
        return batch_of(self.rows.sparkSession, ids, *lists)

    def upsert(self, ids, documents=None, metadatas=None, embeddings=None) -> "Collection":
        """Lists, or one frame with those columns and ``seq``; an existing id is replaced."""
        batch = self._batch(ids, documents, metadatas, embeddings)
        good, bad = writes.split_valid(batch, self.dim, self.name)
        seq = "seq" if "seq" in batch.columns else None
        return replace(self, rows=writes.upsert(self.rows, good, seq, self.embedder), skipped=bad)

    add = upsert

    def update(self, ids, documents=None, metadatas=None, embeddings=None) -> "Collection":
        batch = self._batch(ids, documents, metadatas, embeddings)
        good, bad = writes.split_update(batch, self.dim, self.name)
        seq = "seq" if "seq" in batch.columns else None
        return replace(self, rows=writes.update(self.rows, good, seq, self.embedder), skipped=bad)

    def delete(self, ids=None, where=None, where_document=None) -> "Collection":
        return replace(self, rows=writes.delete(self.rows, ids, where, where_document))

    def reembed(self) -> "Collection":
        """Fill in the vectors that are missing."""
        return replace(self, rows=embed_where_missing(self.rows, self.embedder))

    def get(self, ids=None, where=None, where_document=None, include=None, limit=None, offset=None) -> DataFrame:
        return reads.get(self.rows, ids, where, where_document, include, limit, offset)

    def query(
        self, query_texts=None, query_embeddings=None, n_results=10, where=None, where_document=None, include=None
    ) -> DataFrame:
        """Lists numbered from 0 as ``query_id``, or frames (``query_id`` and ``text`` or
        ``embedding``). Neither gives no rows."""
        spark, options = self.rows.sparkSession, dict(
            n_results=n_results, where=where, where_document=where_document, include=include
        )
        if query_embeddings is None and query_texts is not None:
            if not isinstance(query_texts, DataFrame):
                query_texts = spark.createDataFrame(list(enumerate(query_texts)), "query_id long, text string")
            return search.query_texts(self.rows, query_texts, self.embedder, **options)
        if not isinstance(query_embeddings, DataFrame):
            vectors = [(i, [float(x) for x in v]) for i, v in enumerate(query_embeddings or [])]
            query_embeddings = spark.createDataFrame(vectors, "query_id long, embedding array<double>")
        return search.query(self.rows, query_embeddings, **options)

    def count(self) -> int:
        return reads.count(self.rows).first().n

    def count_by(self, field: str, where=None) -> DataFrame:
        return reads.count_by(self.rows, field, where)

    def capacity_status(self) -> DataFrame:
        return reports.capacity_status(self.rows)


@dataclass(frozen=True)
class FactGraph:
    """Entities and temporal facts. ``outcomes`` tells what became of the last write's rows."""

    entities: DataFrame
    triples: DataFrame
    outcomes: DataFrame | None = None

    @classmethod
    def empty(cls, spark: SparkSession) -> "FactGraph":
        return cls(nothing(spark, ENTITY_SCHEMA), nothing(spark, TRIPLE_SCHEMA))

    @property
    def _spark(self):
        return self.entities.sparkSession

    @staticmethod
    def _now():
        return datetime.now(timezone.utc).isoformat()

    def add_entity(self, name: str, entity_type: str = "unknown", properties=None) -> "FactGraph":
        row = [(name, entity_type, json.dumps(properties or {}))]
        return self.add_entities(self._spark.createDataFrame(row, "name string, type string, properties string"))

    def add_entities(self, batch: DataFrame) -> "FactGraph":
        seq = "seq" if "seq" in batch.columns else None
        return replace(self, entities=fact_writes.upsert_entities(self.entities, batch, self._now(), seq))

    def add_triple(
        self, subject, predicate, obj, valid_from=None, valid_to=None, confidence=1.0,
        source_closet=None, source_file=None, source_drawer_id=None, adapter_name=None,
    ) -> "FactGraph":
        row = (0, subject, predicate, obj, valid_from, valid_to, confidence,
               source_closet, source_file, source_drawer_id, adapter_name)
        schema = "seq long, subject string, predicate string, object string, valid_from string, valid_to string, "
        schema += "confidence double, " + ", ".join(f"{c} string" for c in PROVENANCE)
        return self.add_triples(self._spark.createDataFrame([row], schema))

    def add_triples(self, batch: DataFrame) -> "FactGraph":
        return FactGraph(*fact_writes.add_facts(self.entities, self.triples, batch, self._now()))

    def invalidate(self, subject, predicate, obj, ended=None) -> "FactGraph":
        schema = "seq long, subject string, predicate string, object string, ended string"
        return self.invalidate_all(self._spark.createDataFrame([(0, subject, predicate, obj, ended)], schema))

    def invalidate_all(self, endings: DataFrame) -> "FactGraph":
        done = fact_writes.invalidate(self.triples, endings)
        return replace(self, triples=done.triples, outcomes=done.rejects)

    def apply_events(self, events: DataFrame) -> "FactGraph":
        return FactGraph(*fact_events.apply_events(self.entities, self.triples, events, self._now()))

    def seed_from_entity_facts(self, entity_facts: dict) -> "FactGraph":
        """Person records as a dict of dicts."""
        schema = "seq long, key string, " + ", ".join(f"{c} string" for c in seeding.FIELDS)
        rows = [
            (i, key, *[facts.get(c) for c in seeding.FIELDS], facts.get("interests"))
            for i, (key, facts) in enumerate(entity_facts.items())
        ]
        return self.seed(self._spark.createDataFrame(rows, schema + ", interests array<string>"))

    def seed(self, records: DataFrame) -> "FactGraph":
        return FactGraph(*seeding.seed(self.entities, self.triples, records, self._now()))

    def query_entity(self, name: str, as_of=None, direction: str = "outgoing") -> DataFrame:
        return fact_reads.query_entity(self.entities, self.triples, name, as_of, direction)

    def query_entities(self, probes: DataFrame, direction: str = "outgoing") -> DataFrame:
        return fact_reads.query_entities(self.entities, self.triples, probes, direction)

    def query_relationship(self, predicate: str, as_of=None) -> DataFrame:
        return fact_reads.query_relationship(self.entities, self.triples, predicate, as_of)

    def timeline(self, entity_name=None) -> DataFrame:
        return fact_reads.timeline(self.entities, self.triples, entity_name)

    def stats(self) -> DataFrame:
        return fact_reads.stats(self.entities, self.triples)

    def relationship_types(self) -> DataFrame:
        return fact_reads.predicates(self.triples)

    def current_facts(self) -> DataFrame:
        return fact_reads.current_facts(self.triples)
