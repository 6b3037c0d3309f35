"""Keyed writes. Each takes the current collection and returns the next one; the caller
writes that to a new snapshot and never over the path being read."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.filters import condition, refuse_document_filter
from ..functions.metadata import default_metadata, is_json_object, with_promoted
from ..functions.vectors import has_null_component, scrub
from ..schemas import COLLECTION_INPUT_SCHEMA, COLLECTION_SCHEMA, WIDTH_LIMITS
from .embedding import embed_by_content
from .reads import _given, restrict_ids

ERROR_CHARS = 300
PREVIEW_CHARS = 200


def normalized(batch: DataFrame) -> DataFrame:
    """Fill absent columns and defaults, zero the non-finite vector components and derive the
    promoted columns. Extra columns (such as ``seq``) pass through."""
    absent = {
        f.name: F.lit(None).cast(f.dataType)
        for f in COLLECTION_INPUT_SCHEMA.fields
        if f.name not in batch.columns
    }
    filled = batch.withColumns(absent) if absent else batch
    return with_promoted(
        filled.withColumns({"metadata": default_metadata(), "embedding": scrub("embedding")})
    )


def row_error(dim: int, limits=WIDTH_LIMITS):
    """Why a normalized row cannot be stored, or NULL."""
    checks = [
        (F.col("id").isNull(), "id is missing"),
        (~F.coalesce(is_json_object(), F.lit(False)), "metadata is not a JSON object"),
        (has_null_component("embedding"), "embedding has a missing component"),
        (
            F.col("embedding").isNotNull() & (F.size("embedding") != dim),
            F.concat(
                F.lit("embedding has "), F.size("embedding").cast("string"), F.lit(f" components, not {dim}")
            ),
        ),
    ]
    for name, width in limits.items():
        checks.append((F.length(name) > width, f"{name} is longer than {width} characters"))
    chosen = [F.when(bad, why if not isinstance(why, str) else F.lit(why)) for bad, why in checks]
    return F.coalesce(*chosen)


def split_valid(batch: DataFrame, dim: int, table: str = "", ts=None):
    """(good rows, quarantine rows): one bad row never holds back the others."""
    checked = normalized(batch).withColumn("_error", row_error(dim))
    good = checked.filter("_error IS NULL").drop("_error")
    bad = checked.filter("_error IS NOT NULL").select(
        (F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")).alias("ts"),
        F.lit(table).alias("table"),
        "id",
        "source_file",
        "room",
        F.substring("_error", 1, ERROR_CHARS).alias("error"),
        F.substring(F.coalesce("document", F.lit("")), 1, PREVIEW_CHARS).alias("doc_preview"),
    )
    return good, bad


def split_update(batch: DataFrame, dim: int, table: str = "", ts=None):
    """As :func:`split_valid` for an update: good rows keep the columns they came with."""
    good, bad = split_valid(batch, dim, table, ts)
    return good.select(batch.columns), bad


def last_per_id(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """The row with the highest ``seq`` of each id. An aggregate, so copies of a hot id are
    folded on the map side and never meet in one task."""
    rest = [c for c in batch.columns if c not in ("id", seq)]
    kept = batch.groupBy("id").agg(F.max_by(F.struct(*rest), F.col(seq)).alias("kept"))
    return kept.select("id", "kept.*")


def upsert(
    collection: DataFrame, batch: DataFrame, seq: str | None = None, embedder=None
) -> DataFrame:
    """Insert or wholly replace by id. ``batch`` holds rows fit to store (see
    :func:`split_valid`); with ``seq`` the last row per id wins, without it any one of them.
    Rows lacking a vector get one from ``embedder``, which sees each distinct text once."""
    rows = normalized(batch)
    rows = last_per_id(rows, seq) if seq is not None else last_per_id(rows.withColumn("_seq", F.lit(0)), "_seq")
    if embedder is not None:
        rows = embed_by_content(rows, embedder)
    rows = rows.select(COLLECTION_SCHEMA.names)
    kept = collection.select(COLLECTION_SCHEMA.names).join(rows.select("id"), "id", "left_anti")
    return kept.unionByName(rows)


SUPPLIED = {"document": "set_document", "metadata": "set_metadata", "embedding": "set_embedding"}


def update(
    collection: DataFrame, batch: DataFrame, seq: str | None = None, embedder=None
) -> DataFrame:
    """Change only what ``batch`` supplies, for ids that exist.

    A column counts as supplied when the batch has it; a boolean ``set_<column>`` beside it
    narrows that to some rows. Metadata is replaced, not merged. A new document without a
    vector is embedded again; without an embedder its vector becomes NULL, as the old one
    belongs to the old text. With ``seq`` each column takes its last supplied value, without it
    any one. ``batch`` holds rows fit to store (see :func:`split_update`).
    """
    changes = _changes(batch, seq, embedder)
    if changes is None:
        return collection
    columns = [c for c in SUPPLIED if c in changes.columns]
    joined = collection.join(
        changes.withColumnsRenamed({c: f"_{c}" for c in columns}), "id", "left"
    )
    updated = joined.withColumns(
        {c: F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.v")).otherwise(F.col(c)) for c in columns}
    ).select(collection.columns)
    if "metadata" not in columns:
        return updated
    return with_promoted(updated).select(collection.columns)


def _changes(batch, seq, embedder):
    """Per id, one struct ``{v}`` per column: NULL struct means untouched."""
    columns = [c for c in SUPPLIED if c in batch.columns]
    if not columns:
        return None
    given = {c: F.col(SUPPLIED[c]) if SUPPLIED[c] in batch.columns else F.lit(True) for c in columns}
    rows = batch.withColumns({SUPPLIED[c]: F.coalesce(flag, F.lit(False)) for c, flag in given.items()})
    if "metadata" in columns:
        rows = rows.withColumn("metadata", default_metadata())
    if "embedding" in columns:
        rows = rows.withColumn("embedding", scrub("embedding"))
    if "document" in columns:
        if "embedding" not in columns:
            columns.append("embedding")
            rows = rows.withColumns(
                {"embedding": F.lit(None).cast("array<float>"), "set_embedding": F.lit(False)}
            )
        stale = F.col("set_document") & ~F.col("set_embedding")
        if embedder is not None:
            rows = embed_by_content(rows, embedder, where=stale)
        else:
            rows = rows.withColumn("embedding", F.when(~stale, F.col("embedding")))
        rows = rows.withColumn("set_embedding", F.col("set_embedding") | F.col("set_document"))
    wrapped = {c: F.when(F.col(SUPPLIED[c]), F.struct(F.col(c).alias("v"))) for c in columns}
    order = F.lit(0) if seq is None else F.col(seq)
    return rows.groupBy("id").agg(
        *[F.max_by(w, F.when(F.col(SUPPLIED[c]), order)).alias(c) for c, w in wrapped.items()]
    )


def delete(collection: DataFrame, ids=None, where=None, where_document=None) -> DataFrame:
    """Drop rows by id, else by filter, else nothing. A filter that is not true for a row
    (a missing key included) keeps it; one without any condition is refused."""
    refuse_document_filter(where_document)
    if _given(ids):
        return restrict_ids(collection, ids, "left_anti")
    if not where:
        return collection
    found = condition(where, collection.columns)
    if found is None:
        raise ValueError("the filter holds no condition; refusing to delete every row")
    return collection.filter(~F.coalesce(found, F.lit(False)))
