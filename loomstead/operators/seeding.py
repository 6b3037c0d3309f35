"""Expanding person records into entities and facts.

A record has ``seq`` and ``key`` and, as far as known: full_name, type, gender, birthday,
parent, partner, relationship, sibling, owner (strings) and interests (array of strings).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import capitalize, capitalized
from .fact_writes import FactWrite, add_facts, upsert_entities

# The start given to interests, and facts per relationship: its predicate and
# the record field naming the other person.
INTEREST_START = "2025-01-01"
RELATIONSHIPS = {
    "husband": ("is_partner_of", "partner"),
    "brother": ("is_sibling_of", "sibling"),
    "dog": ("is_pet_of", "owner"),
}
FIELDS = ("full_name", "type", "gender", "birthday", "parent", "partner", "relationship", "sibling", "owner")


def _complete(records: DataFrame) -> DataFrame:
    absent = {c: F.lit(None).cast("string") for c in FIELDS if c not in records.columns}
    if "interests" not in records.columns:
        absent["interests"] = F.lit(None).cast("array<string>")
    records = records.withColumns(absent) if absent else records
    return records.withColumn("name", F.coalesce("full_name", capitalize("key")))


def seed_entities(records: DataFrame) -> DataFrame:
    """Entity upserts in call order: seq, name, type, properties. A dog is upserted a second
    time, as an animal without properties."""
    r = _complete(records)
    blank = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("gender", "birthday")}
    person = F.struct(
        F.lit(0).alias("step"),
        F.coalesce("type", F.lit("person")).alias("type"),
        F.to_json(F.struct(*blank.values())).alias("properties"),
    )
    animal = F.struct(
        F.lit(1).alias("step"), F.lit("animal").alias("type"), F.lit("{}").alias("properties")
    )
    calls = F.when(F.col("relationship") == "dog", F.array(person, animal)).otherwise(F.array(person))
    return r.select("seq", "name", F.explode(calls).alias("e")).select(
        F.struct("seq", "e.step").alias("seq"), "name", "e.type", "e.properties"
    )


def _fact(predicate, other, start=None):
    return F.struct(
        F.lit(predicate).alias("predicate"),
        other.alias("object"),
        (F.lit(None).cast("string") if start is None else start).alias("valid_from"),
    )


def seed_facts(records: DataFrame) -> DataFrame:
    """The facts in call order: seq (record, step), subject, predicate, object, valid_from."""
    r = _complete(records)
    name, kind = F.col("name"), F.col("relationship")

    def known(column):
        return F.coalesce(F.col(column) != "", F.lit(False))

    parent = F.when(known("parent"), capitalize("parent"))
    calls = [
        F.when(known("parent"), _fact("child_of", parent, F.col("birthday"))),
        F.when(known("partner"), _fact("married_to", capitalize("partner"))),
        F.when(kind == "daughter", _fact("is_child_of", F.coalesce(parent, name), F.col("birthday"))),
    ]
    for word, (predicate, field) in RELATIONSHIPS.items():
        calls.append(F.when(kind == word, _fact(predicate, capitalize(f"coalesce({field}, name)"))))
    likes = F.expr(
        f"""transform(coalesce(interests, array()), i -> named_struct(
            'predicate', 'loves', 'object', {capitalized('i')}, 'valid_from', '{INTEREST_START}'))"""
    )
    steps = F.concat(F.filter(F.array(*calls), lambda c: c.isNotNull()), likes)
    return r.select("seq", "name", F.posexplode(steps).alias("step", "f")).select(
        F.struct("seq", "step").alias("seq"), F.col("name").alias("subject"), "f.*"
    )


def seed(entities: DataFrame, triples: DataFrame, records: DataFrame, batch_ts: str) -> FactWrite:
    """Apply the records: the last upsert of an entity wins over any mention of it."""
    upserted = upsert_entities(entities, seed_entities(records), batch_ts, seq="seq")
    return add_facts(upserted, triples, seed_facts(records), batch_ts)
