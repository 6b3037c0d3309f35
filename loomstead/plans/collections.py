"""Registered queries over collections."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import _sum, cosine_distance, from_text, mean_pool, scrub, to_text
from ..operators import embedding, reads, reports, search, writes
from ..schemas import COLLECTION_SCHEMA
from ..session import nothing, shared_folder
from ..sources import buckets, dumps, files, tables
from ..streaming import ingest
from . import inputs
from .inputs import DIM, Tables


def _total(vector="embedding"):
    """Two numbers standing for a vector, equal in both engines: its length, and the sum of its
    components times their places, so that an exchange of two shows."""
    sums = _sum(F.transform(vector, lambda x, i: x.cast("double") * (i + 1)))
    return [F.size(vector).cast("long").alias("n"), F.round(sums, 6).alias("total")]


def _shown(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns, *_total())


def _ids(where):
    return lambda t: reads.get(inputs.bare_notes(t), where=where, include=[])


WHERE = {
    "where_eq": {"wing": "en"},
    "where_implicit_and": {"wing": "en", "pinned": True},
    "where_and": {"$and": [{"wing": "de"}, {"room": "src3"}]},
    "where_or": {"$or": [{"wing": "fr"}, {"pinned": True}]},
    "where_nested": {"$or": [{"$and": [{"wing": "es"}, {"chunk": 1}]}, {"$and": [{"wing": "fr"}, {"chunk": 2}]}]},
    "where_eq_op": {"wing": {"$eq": "fr"}},
    "where_scalar": {"chunk": 2},
}


def collection_scan(t: Tables):
    return inputs.notes(t).select(
        "id", "metadata", "wing", "room", "source_file", F.length("document").alias("chars"),
        F.col("embedding").isNotNull().alias("embedded"),
    )


def snapshot_load(t):
    """The collection written as a snapshot whose lookups are served by Bloom filters, and read back."""
    root = shared_folder(t.spark)
    tables.write_snapshot(inputs.notes(t), root, **tables.lookup_options("id"))
    return _stored(tables.read_snapshot(t.spark, root, COLLECTION_SCHEMA)[1])


def get_where(t):
    return reads.get(inputs.bare_notes(t), where={"source_file": "corpus/en/src3.txt"})


def _labelled_ids(t):
    return t.labels.select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("id"))


def get_ids(t):
    return reads.get(inputs.bare_notes(t), ids=_labelled_ids(t))


def get_ids_where(t):
    return reads.get(
        inputs.bare_notes(t), ids=_labelled_ids(t), where={"$or": [{"wing": "de"}, {"wing": "fr"}]}
    )


def get_include(t):
    return _shown(reads.get(inputs.notes(t), include=["documents", "embeddings"]).filter("embedding IS NOT NULL"),
                  "id", "document")


def get_page(t):
    return reads.get(inputs.bare_notes(t), limit=20, offset=40)


def get_page_deep(t):
    """A page that crosses files of a snapshot stored in id order; no other file is opened."""
    root = shared_folder(t.spark)
    rows = inputs.bare_notes(t).select("id", "document", "metadata")
    tables.write_sorted(rows, root, range_rows=50)
    return tables.read_page(t.spark, root, rows.schema, limit=130, offset=170)


def get_rest(t):
    """Everything after the first 60 rows."""
    return reads.get(inputs.bare_notes(t), offset=60, include=["metadatas"])


def get_flat_result(t):
    flat = reads.flat_result(reads.get(inputs.bare_notes(t), where={"wing": "en"}, limit=20))
    return flat.select(
        F.array_join("ids", "|").alias("ids"),
        F.array_join("documents", "|").alias("documents"),
        F.array_join("metadatas", "|").alias("metadatas"),
    )


def metadata_map(t):
    return reads.decoded_metadata(inputs.bare_notes(t)).select("id", F.explode("metadata"))


def vector_text_roundtrip(t):
    text = t.embeddings.select(F.col("vec_id").alias("id"), to_text("embedding").alias("text"))
    return _shown(text.withColumn("embedding", from_text("text")), "id")


def vector_scrub(t):
    """Vectors with overflown and undefined components."""
    damaged = F.transform(
        "embedding",
        lambda x: F.when(x > 0.2, float("inf")).when(x < -0.2, float("nan")).otherwise(x).cast("float"),
    )
    return _shown(
        t.embeddings.select(F.col("vec_id").alias("id"), scrub(damaged).alias("embedding")), "id"
    )


def _count_by(field, where=None):
    return lambda t: reads.count_by(inputs.bare_notes(t), field, where)


def capacity_status(t):
    return reports.capacity_status(inputs.notes(t))


def collection_inventory(t):
    talk = inputs.talks(t).withColumn("embedding", F.lit(None).cast("array<float>"))
    return reports.collection_inventory({"notes": inputs.notes(t), "talks": talk})


# -- writes -------------------------------------------------------------------------------


def _relabelled(t):
    """A batch replacing every labelled note and adding every page."""
    again = inputs.labelled(t).selectExpr(
        "concat('doc_', doc_id) AS id",
        "text AS document",
        """concat('{"wing":"', lang, '","room":"quality ', quality, '"}') AS metadata""",
    )
    new = t.pages.selectExpr(
        "concat('page_', page_id) AS id",
        "html AS document",
        """concat('{"wing":"web","source_file":"', url, '"}') AS metadata""",
    )
    return again.unionByName(new)


def _stored(df):
    return df.select("id", "document", "metadata", "wing", "room", "source_file",
                     F.col("embedding").isNotNull().alias("embedded"))


def upsert(t):
    return _stored(writes.upsert(inputs.notes(t), _relabelled(t)))


def upsert_last_wins(t):
    """One row per conversation: its turns share an id and the last one stays."""
    batch = inputs.talks(t).selectExpr("concat('talk_', conv_id) AS id", "document", "metadata", "turn AS seq")
    return _stored(writes.upsert(inputs.notes(t), batch, seq="seq"))


def upsert_defaults(t):
    """Rows with neither text nor metadata."""
    batch = t.labels.select(F.concat(F.lit("label_"), F.col("doc_id")).alias("id"))
    return _stored(writes.upsert(nothing(t.spark, COLLECTION_SCHEMA), batch))


def update_partial(t):
    """Labels replace the metadata of their notes; the text of toxic ones is blanked, and with
    it the vector that was made of it."""
    batch = t.labels.selectExpr(
        "concat('doc_', doc_id) AS id",
        "CAST(NULL AS string) AS document",
        "toxic = 1 AS set_document",
        """concat('{"wing":"labelled","quality":', quality, '}') AS metadata""",
    )
    return _stored(writes.update(inputs.notes(t), batch))


def upsert_buckets(t):
    """Toxic notes are replaced in a table of 64 buckets, of which only those with such notes are
    written again; then those of quality 0 are deleted."""
    root = shared_folder(t.spark)
    buckets.create(inputs.notes(t), root, 64)
    again = inputs.labelled(t).filter("toxic = 1").selectExpr(
        "concat('doc_', doc_id) AS id", "concat('withheld ', quality) AS document", """'{"wing":"withheld"}' AS metadata"""
    )
    buckets.rewrite(t.spark, root, COLLECTION_SCHEMA, again, writes.upsert)
    gone = t.labels.filter("toxic = 1 AND quality = 0").selectExpr("concat('doc_', doc_id) AS id")
    buckets.rewrite(t.spark, root, COLLECTION_SCHEMA, gone, writes.delete)
    return _stored(buckets.read(t.spark, root, COLLECTION_SCHEMA))


def upsert_embedded(t):
    """Copies of all notes under new ids, without vectors: each distinct text is embedded once."""
    batch = t.spread("documents", "doc_id").selectExpr(
        "concat('copy_', doc_id) AS id", "text AS document", """'{"wing":"copy"}' AS metadata"""
    )
    found = writes.upsert(inputs.notes(t), batch, embedder=_embedder())
    return _shown(found.filter("embedding IS NOT NULL"), "id", "wing")


def update_reembedded(t):
    """The texts of toxic notes are replaced, by few different ones, and embedded again; other
    labelled notes change their metadata only and keep their vectors."""
    batch = t.labels.selectExpr(
        "concat('doc_', doc_id) AS id",
        "concat('withheld, quality ', quality) AS document",
        "toxic = 1 AS set_document",
        """concat('{"wing":"labelled","quality":', quality, '}') AS metadata""",
    )
    found = writes.update(inputs.notes(t), batch, embedder=_embedder())
    return _shown(found.filter("embedding IS NOT NULL"), "id", "document", "wing")


def delete_ids(t):
    toxic = t.labels.filter("toxic = 1").select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("id"))
    return reads.get(writes.delete(inputs.bare_notes(t), ids=toxic), include=["metadatas"])


def delete_id_list(t):
    """A list of ids, of which one is missing and one names no note."""
    ids = ["doc_1", None, "doc_3", "nowhere"]
    return reads.get(writes.delete(inputs.bare_notes(t), ids=ids), include=["metadatas"])


def delete_nothing(t):
    """Neither ids nor a filter: every row stays."""
    return reads.get(writes.delete(inputs.bare_notes(t)), include=["metadatas"])


def delete_where(t):
    return reads.get(writes.delete(inputs.bare_notes(t), where={"room": "src3"}), include=["metadatas"])


def _bad(t):
    return writes.split_valid(inputs.mixed_entries(t), DIM, "mixed", inputs.BATCH_TS)[1]


def quarantine(t):
    return _bad(t).drop("ts")


def quarantine_counts(t):
    return reports.quarantine_counts(_bad(t))


def remine_candidates(t):
    return reports.remine_candidates(_bad(t), t.pages.select(F.col("url").alias("id")))


# -- search and embedding -----------------------------------------------------------------


def _hits(df):
    return df.withColumn("distance", F.round("distance", 6))


def cosine_to_prototype(t):
    near = t.embeddings.join(
        inputs.prototypes(t).select(F.col("query_id").alias("label"), F.col("embedding").alias("mean")), "label"
    )
    return near.select("vec_id", F.round(cosine_distance("embedding", "mean"), 6).alias("distance"))


def knn_single(t):
    return _hits(search.query(inputs.notes(t), inputs.centre(t), 10, include=["distances"]))


def knn_batch(t):
    return _hits(search.query(inputs.notes(t), inputs.prototypes(t), 10))


def knn_filtered(t):
    return _hits(search.query(inputs.notes(t), inputs.prototypes(t), 10, where={"wing": "en"}))


def knn_blocked(t):
    """The form for query tables of any size, forced by a small limit."""
    return _hits(
        search.query(inputs.notes(t), inputs.prototypes(t), 10, include=["distances"],
                     matrix_queries=1, block_rows=10_000)
    )


def query_nested_result(t):
    nested = search.nested_result(search.query(inputs.notes(t), inputs.prototypes(t), 10, include=["distances"]))
    return nested.select(
        "query_id",
        F.array_join("ids", "|").alias("ids"),
        F.round(_sum(F.col("distances")), 6).alias("total"),
    )


def _embedder():
    return embedding.HashedTextEmbedder(DIM)


def _embedded_notes(t):
    return embedding.embed_documents(inputs.bare_notes(t), _embedder())


def embed_documents(t):
    return _shown(_embedded_notes(t), "id")


def knn_text(t):
    texts = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    hits = search.query_texts(_embedded_notes(t), texts, _embedder(), n_results=10, include=["distances"])
    return _hits(hits)


def pooled(t):
    """Each vector read as eight token vectors, masked by the sign of their first component."""
    tokens = F.expr("transform(sequence(0, 7), i -> slice(embedding, i * 8 + 1, 8))")
    mask = F.expr("transform(tokens, t -> CAST(t[0] > 0 AS int))")
    rows = t.embeddings.select("vec_id", tokens.alias("tokens")).withColumn("mask", mask)
    return _shown(rows.select("vec_id", mean_pool("tokens", "mask", 8).alias("embedding")), "vec_id")


def embedding_parity(t):
    left = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    means = inputs.prototypes(t).select(F.col("query_id").alias("label"), "embedding")
    right = t.embeddings.select(F.col("vec_id").alias("id"), "label").join(means, "label")
    found = embedding.embedding_parity(left, right)
    return found.select("pairs", *[F.round(c, 6).alias(c) for c in ("min_cosine", "avg_cosine", "max_cosine")])


# -- dumps and ingest ---------------------------------------------------------------------


def export_rows(t):
    rows = dumps.export_rows(inputs.notes(t))
    parts = F.size(F.split(F.expr("substring(embedding, 2, length(embedding) - 2)"), ","))
    return rows.select("id", "document", "metadata", F.when(F.col("embedding").isNotNull(), parts.cast("long")).alias("n"))


def _tables(t):
    talk = inputs.talks(t).select("id", "document", "metadata")
    return {"notes": inputs.notes(t), "talks": talk, "triples": inputs.triples(t)}


def backup_manifest(t):
    lines = dumps.manifest(_tables(t), "20260101-000000Z")
    return lines.select(
        "table", "rows", F.array_join("columns", ",").alias("columns"),
        F.array_join("vector_columns", ",").alias("vector_columns"), "created",
    )


def restore_dry_run(t):
    now = {
        "notes": writes.delete(inputs.bare_notes(t), where={"wing": "de"}),
        "pages": t.pages,
        "talks": inputs.talks(t),
    }
    return dumps.dry_run(dumps.manifest(_tables(t)), now)


def restore_roundtrip(t):
    folder = shared_folder(t.spark)
    dumps.export_tables({"notes": inputs.notes(t)}, folder)
    back = dumps.load_dumped(t.spark, folder, "notes", COLLECTION_SCHEMA)
    return _shown(back, "id", "document", "metadata", "wing", "room", "source_file")


def ingest_discover(t):
    known = inputs.manifest(t).filter("status = 'done'")
    return files.new_files(inputs.files(t), known).select("path", "status", "mtime")


def ingest_status(t):
    return reports.ingest_status(inputs.manifest(t), run_files=30, run_seconds=60)


def already_mined(t):
    """The files that notes name, and for each whether a labelled note without a room is from it."""
    asked = inputs.bare_notes(t).select("source_file").distinct()
    mined = inputs.bare_notes(t).join(_labelled_ids(t), "id", "left_semi").filter("room IS NULL")
    return reports.already_mined(asked, mined)


def quarantine_cut_lines(t):
    """An ingest of lines some of which break off, and some of which hold a number for a vector."""
    root = shared_folder(t.spark)
    lines = t.labels.selectExpr("""concat('{"id":"doc_', doc_id, '","document":"text"',
        CASE WHEN quality = 0 THEN ',"embedding":7' ELSE '' END, CASE WHEN toxic = 1 THEN '' ELSE '}' END) AS value""")
    lines.write.text(f"{root}/in")
    ingest.ingest(t.spark, f"{root}/in", f"{root}/store", DIM, glob="*.txt")
    bad = ingest.quarantined(t.spark, f"{root}/store").select("error", F.col("doc_preview").alias("raw"))
    # The whole lines are kept beside the quarantine.
    kept = ingest.unreadable(t.spark, f"{root}/store").select(F.lit("kept").alias("error"), "raw")
    good = ingest.stored_rows(t.spark, f"{root}/store").select(F.lit("filed").alias("error"), F.col("id").alias("raw"))
    return bad.unionByName(kept).unionByName(good)


QUERIES = {
    "collection_scan": collection_scan,
    **{name: _ids(where) for name, where in WHERE.items()},
    "snapshot_load": snapshot_load,
    "where_empty": _ids({}),
    "get_where": get_where,
    "get_ids": get_ids,
    "get_ids_where": get_ids_where,
    "get_include": get_include,
    "get_page": get_page,
    "get_page_deep": get_page_deep,
    "get_rest": get_rest,
    "get_flat_result": get_flat_result,
    "metadata_map": metadata_map,
    "vector_text_roundtrip": vector_text_roundtrip,
    "vector_scrub": vector_scrub,
    "count": lambda t: reads.count(inputs.bare_notes(t)),
    "count_by_wing": _count_by("wing"),
    "count_by_room": _count_by("room"),
    "count_by_source_file": _count_by("source_file"),
    "count_by_where": _count_by("room", {"wing": "en", "pinned": True}),
    "count_tree": lambda t: reads.count_tree(inputs.bare_notes(t)),
    "capacity_status": capacity_status,
    "collection_inventory": collection_inventory,
    "upsert": upsert,
    "upsert_last_wins": upsert_last_wins,
    "upsert_defaults": upsert_defaults,
    "update_partial": update_partial,
    "upsert_buckets": upsert_buckets,
    "upsert_embedded": upsert_embedded,
    "update_reembedded": update_reembedded,
    "delete_ids": delete_ids,
    "delete_id_list": delete_id_list,
    "delete_nothing": delete_nothing,
    "delete_where": delete_where,
    "quarantine": quarantine,
    "quarantine_counts": quarantine_counts,
    "quarantine_cut_lines": quarantine_cut_lines,
    "remine_candidates": remine_candidates,
    "cosine_distance": cosine_to_prototype,
    "knn_single": knn_single,
    "knn_batch": knn_batch,
    "knn_filtered": knn_filtered,
    "knn_blocked": knn_blocked,
    "knn_text": knn_text,
    "query_nested_result": query_nested_result,
    "embed_documents": embed_documents,
    "mean_pool": pooled,
    "embedding_parity": embedding_parity,
    "export_rows": export_rows,
    "backup_manifest": backup_manifest,
    "restore_dry_run": restore_dry_run,
    "restore_roundtrip": restore_roundtrip,
    "ingest_discover": ingest_discover,
    "ingest_status": ingest_status,
    "already_mined": already_mined,
}
