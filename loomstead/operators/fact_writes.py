"""Writing temporal facts in batches that give what the single calls in order would give.

A batch carries ``seq``, a unique value giving the order of the calls. What a call does
depends only on a few facts per (subject, predicate, object): whether a fact is open, which
one opened first, the latest start among the open ones. Each is a min or max, so keys are
folded on the map side and joined back as one row per key; no window or collected group ever
holds a hot key's rows.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import entity_slug, predicate_slug
from ..functions.temporal import inverted, malformed, start_key
from ..schemas import ENTITY_SCHEMA, FACT_KEY, PROVENANCE, TRIPLE_SCHEMA
from ..session import join_per_key

KEY = list(FACT_KEY)


class FactWrite(NamedTuple):
    entities: DataFrame
    triples: DataFrame
    outcomes: DataFrame  # seq, status, fact_id, reason


class Invalidation(NamedTuple):
    triples: DataFrame
    rejects: DataFrame  # the refused endings with a reason


def keyed(batch: DataFrame) -> DataFrame:
    """Turn names into slugs, keeping the given spelling as ``subject_name``/``object_name``."""
    batch = batch.withColumnsRenamed({"subject": "subject_name", "object": "object_name"})
    return batch.withColumns(
        {
            "subject": entity_slug("subject_name"),
            "predicate": predicate_slug("predicate"),
            "object": entity_slug("object_name"),
        }
    )


def _filled(batch: DataFrame) -> DataFrame:
    optional = {name: "string" for name in ("valid_from", "valid_to", *PROVENANCE)} | {"confidence": "double"}
    columns = {c: F.expr(f"CAST(NULL AS {kind})") for c, kind in optional.items() if c not in batch.columns}
    columns["confidence"] = F.expr("coalesce(confidence, 1D)" if "confidence" in batch.columns else "1D")
    return batch.withColumns(columns)


# Why a fact cannot be stored, or NULL.
FACT_ERROR = f"""CASE
    WHEN subject IS NULL OR predicate IS NULL OR object IS NULL THEN 'subject, predicate and object are required'
    WHEN {malformed('valid_from')} THEN 'valid_from is not an ISO date or date-time'
    WHEN {malformed('valid_to')} THEN 'valid_to is not an ISO date or date-time'
    WHEN {inverted()} THEN 'the interval ends before it starts' END"""


def _quoted(text: str) -> str:
    """A text as a SQL literal, whatever it holds."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digest_sql(salt: str) -> str:
    """12 hex digits over start, salt (the batch time) and order, as a number: unlike text it
    can be folded in a hash aggregate."""
    digest = f"sha2(concat(coalesce(valid_from, 'None'), {_quoted(salt)}, CAST(seq AS string)), 256)"
    return f"CAST(conv(substring({digest}, 1, 12), 16, 10) AS BIGINT)"


def _id_of(digest: str) -> str:
    return f"concat('t_', {', "_", '.join(KEY)}, '_', lpad(lower(hex({digest})), 12, '0'))"


def fact_id_sql(salt: str) -> str:
    """Stable id: the key and 12 hex digits over start, salt (the batch time) and order."""
    return _id_of(_digest_sql(salt))


def _at(ts: str) -> Column:
    return F.lit(str(ts)).cast("timestamp")


# -- entities -----------------------------------------------------------------------------


def upsert_entities(entities: DataFrame, batch: DataFrame, batch_ts, seq: str | None = None) -> DataFrame:
    """Insert or overwrite name, type and properties by slug of ``name``; an existing row
    keeps its ``created_at``. With ``seq`` the last row per slug wins."""
    given = set(batch.columns)
    rows = batch.select(
        entity_slug("name").alias("id"),
        "name",
        (F.coalesce("type", F.lit("unknown")) if "type" in given else F.lit("unknown")).alias("type"),
        (F.coalesce("properties", F.lit("{}")) if "properties" in given else F.lit("{}")).alias("properties"),
        *([seq] if seq else []),
    ).filter("id IS NOT NULL")
    value = F.struct("name", "type", "properties")
    rows = rows.groupBy("id").agg(F.max_by(value, F.col(seq) if seq else F.lit(0)).alias("new"))
    # Both joins of the stored entities have the batch on the side that may be broadcast, so a
    # small batch leaves them where they lie.
    untouched = entities.select(ENTITY_SCHEMA.names).join(rows.select("id"), "id", "left_anti")
    before = entities.select("id", "created_at").join(rows.select("id"), "id", "left_semi")
    created = F.coalesce("created_at", _at(batch_ts)).alias("created_at")
    return untouched.unionByName(rows.join(before, "id", "left").select("id", "new.*", created))


def mentioned(facts: DataFrame, batch_ts) -> DataFrame:
    """The subjects and objects of ``facts`` as entities, named as first spelled."""
    ends = """inline(array(
        named_struct('id', subject, 'name', subject_name, 'at', named_struct('seq', seq, 'side', 0)),
        named_struct('id', object, 'name', object_name, 'at', named_struct('seq', seq, 'side', 1))))"""
    named = facts.selectExpr(ends).groupBy("id").agg(F.min_by("name", "at").alias("name"))
    return named.select(
        "id",
        "name",
        F.expr("'unknown' AS type"),
        F.expr("CAST(NULL AS string) AS properties"),
        _at(batch_ts).alias("created_at"),
    )


def add_mentioned(entities: DataFrame, facts: DataFrame, batch_ts) -> DataFrame:
    """Add the subjects and objects of ``facts`` that are not entities yet; existing entities
    stay as they are."""
    named = mentioned(facts, batch_ts)
    # narrowed to the batch first, which a small batch does without moving the entities
    known = entities.select("id").join(named.select("id"), "id", "left_semi")
    new = named.join(known, "id", "left_anti")
    return entities.select(ENTITY_SCHEMA.names).unionByName(new)


# -- facts --------------------------------------------------------------------------------


def _open_per_key(triples: DataFrame, keys: DataFrame) -> DataFrame:
    """Open stored facts of the given keys only: a small batch is broadcast, so the stored
    facts are filtered where they lie instead of being shuffled."""
    return join_per_key(triples.filter("valid_to IS NULL"), keys, KEY, "left_semi")


def judged(triples: DataFrame, batch: DataFrame, batch_ts: str) -> DataFrame:
    """The batch with what becomes of each row: ``status`` is inserted, existing (an open fact
    with the same key was there first; its id is returned) or rejected (with ``reason``)."""
    rows = _filled(keyed(batch)).selectExpr("*", f"{FACT_ERROR} AS reason", f"{_digest_sql(batch_ts)} AS digest")
    fit = rows.filter("reason IS NULL")
    stored = _open_per_key(triples, fit.select(KEY).distinct()).groupBy(*KEY).agg(F.expr("min(id) AS stored_id"))
    opened = fit.filter("valid_to IS NULL").groupBy(*KEY).agg(
        F.expr("min(seq) AS open_seq"),
        F.expr("min_by(digest, seq) AS open_digest"),
    )
    # apart, as the texts among the stored facts would make the fold of the batch sort its rows
    first = stored.join(opened, KEY, "full")
    met = f"coalesce(stored_id, CASE WHEN open_seq < seq THEN {_id_of('open_digest')} END)"
    status = f"CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN {met} IS NULL THEN 'inserted' ELSE 'existing' END"
    return (
        join_per_key(rows, first, KEY, "left")
        .selectExpr("*", f"{status} AS status", f"CASE WHEN reason IS NULL THEN coalesce({met}, {_id_of('digest')}) END AS fact_id")
        .drop("stored_id", "open_seq", "open_digest", "digest")
    )


def inserted_facts(judgement: DataFrame, batch_ts) -> DataFrame:
    return (
        judgement.filter("status = 'inserted'")
        .withColumns({"id": F.col("fact_id"), "extracted_at": _at(batch_ts)})
        .select(TRIPLE_SCHEMA.names)
    )


def add_facts(entities: DataFrame, triples: DataFrame, batch: DataFrame, batch_ts: str) -> FactWrite:
    """Add facts (``seq, subject, predicate, object`` by name, the rest optional).

    A fact repeating an open one is not inserted, even if it is closed itself; closed facts
    never stand in the way. Ill-formed and inverted facts are rejected alone and add no
    entities, while a repeated fact still does.
    """
    judgement = judged(triples, batch, batch_ts)
    accepted = _filled(keyed(batch)).filter(f"{FACT_ERROR} IS NULL")
    return FactWrite(
        add_mentioned(entities, accepted, batch_ts),
        triples.select(TRIPLE_SCHEMA.names).unionByName(inserted_facts(judgement, batch_ts)),
        judgement.select("seq", "status", "fact_id", "reason"),
    )


def invalidate(triples: DataFrame, endings: DataFrame, today: str | None = None) -> Invalidation:
    """Close open facts (``seq, subject, predicate, object`` by name, ``ended`` or today).

    An ending closes every open fact of its key, unless one of them starts later: then it is
    refused and changes nothing. The first one that is not refused closes the key, so later
    endings find nothing open and are not refused.
    """
    day = F.current_date().cast("string") if today is None else F.lit(today)
    blank = F.nullif(F.col("ended"), F.lit("")) if "ended" in endings.columns else F.lit(None)
    asked = keyed(endings).withColumn("ended", F.coalesce(blank.cast("string"), day))
    latest = (
        _open_per_key(triples, asked.select(KEY).distinct())
        .groupBy(*KEY)
        .agg(F.max(start_key("valid_from")).alias("_latest"), F.expr("true AS _open"))
    )
    found = join_per_key(asked, latest, KEY, "left").selectExpr(
        "*",
        f"{malformed('ended')} AS _bad",
        f"{inverted('_latest', 'ended')} AS _late",
    )
    closing = (
        found.filter("_open AND NOT _bad AND NOT _late")
        .groupBy(*KEY)
        .agg(F.min_by("ended", "seq").alias("_ended"), F.min("seq").alias("_closed_at"))
    )
    # only open facts can change, so the finished ones are neither shuffled nor joined
    still = join_per_key(triples.filter("valid_to IS NULL"), closing.drop("_closed_at"), KEY, "left")
    closed = triples.filter("valid_to IS NOT NULL").unionByName(
        still.withColumn("valid_to", F.col("_ended")).select(triples.columns)
    )
    refused = join_per_key(found.filter("_bad OR _late"), closing.drop("_ended"), KEY, "left")
    rejects = refused.filter("_bad OR _closed_at IS NULL OR seq < _closed_at").selectExpr(
        "seq",
        *KEY,
        "ended",
        """CASE WHEN _bad THEN 'ended is not an ISO date or date-time'
            ELSE 'the interval ends before it starts' END AS reason""",
    )
    return Invalidation(closed, rejects)
