import math
import sys

import pytest
from loomstead.functions.metadata import with_promoted
from loomstead.operators import reads, writes
from loomstead.operators.embedding import HashedTextEmbedder
from loomstead.schemas import COLLECTION_SCHEMA
from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])  # the workers cannot import this file

INPUT = "id string, document string, metadata string, embedding array<float>, seq long"


class VowelShares:
    """Shares of three vowels among the letters a, e and o of a text, as whole counts."""

    dim = 3

    def embed(self, texts):
        return [[float(text.count(vowel)) for vowel in "aeo"] for text in texts]


@pytest.fixture()
def base(spark):
    data = [
        ("a", "alpha", '{"wing":"w"}', [1.0, 0.0, 0.0], "w", None, None),
        ("b", "beta", '{"wing":"v","room":"r"}', [0.0, 1.0, 0.0], "v", "r", None),
    ]
    return spark.createDataFrame(data, COLLECTION_SCHEMA)


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_upsert_replaces_whole_rows(base, rows):
    batch = rows(INPUT, ("b", "new", None, None, 1), ("c", None, '{"room":"q"}', [0.0, 0.0, 2.0], 1))
    out = by_id(writes.upsert(base, batch))
    assert set(out) == {"a", "b", "c"}
    assert (out["b"].document, out["b"].metadata, out["b"].wing, out["b"].embedding) == ("new", "{}", None, None)
    assert (out["c"].document, out["c"].room) == (None, "q")
    assert out["a"].document == "alpha"


def test_last_wins(base, rows):
    batch = rows(INPUT, *[("a", f"v{i}", None, None, i) for i in (3, 9, 5)])
    assert by_id(writes.upsert(base, batch, seq="seq"))["a"].document == "v9"


def test_last_wins_keeps_nulls(base, rows):
    batch = rows(INPUT, ("a", "v1", None, None, 1), ("a", None, None, None, 2))
    assert by_id(writes.upsert(base, batch, seq="seq"))["a"].document is None


def test_defaults_and_empty_batch(base, rows):
    out = by_id(writes.upsert(base, rows("id string", ("z",)), embedder=VowelShares()))
    assert (out["z"].document, out["z"].metadata) == (None, "{}")
    assert list(out["z"].embedding) == [0.0, 0.0, 0.0]  # the text of a missing document is empty
    assert len(by_id(writes.upsert(base, rows(INPUT)))) == 2


def test_scrub_and_quarantine(rows):
    nan, inf = float("nan"), float("inf")
    batch = rows(
        INPUT,
        ("ok", "fine", None, [nan, inf, -inf], 1),
        (None, "no id", None, None, 1),
        ("x" * 192, "long id", None, None, 1),
        ("x" * 191, "longest id", None, None, 1),
        ("short", "vector", None, [1.0], 1),
        ("hole", "vector", None, [1.0, None, 1.0], 1),
        ("json", "d" * 500, "not json", None, 1),
        ("list", "x", "[1]", None, 1),
        ("room", "x", '{"room":"%s"}' % ("r" * 256), None, 1),
        ("null", "x", "null", None, 1),
    )
    good, bad = writes.split_valid(batch, 3, "t")
    good = by_id(good)
    assert set(good) == {"ok", "x" * 191, "null"}
    assert list(good["ok"].embedding) == [0.0, 0.0, 0.0]
    bad = by_id(bad)
    assert set(bad) == {None, "x" * 192, "short", "hole", "json", "list", "room"}
    assert bad["short"].error == "embedding has 1 components, not 3"
    assert (len(bad["json"].doc_preview), bad["json"].table) == (200, "t")
    assert bad["room"].room == "r" * 256


def test_update_touches_only_what_is_given(base, rows):
    out = by_id(writes.update(base, rows("id string, document string", ("a", "banana"), ("nope", "x"))))
    assert set(out) == {"a", "b"}
    # the old vector belongs to the old text, and there is nothing to make a new one with
    assert (out["a"].document, out["a"].metadata, out["a"].embedding) == ("banana", '{"wing":"w"}', None)
    assert list(out["b"].embedding) == [0, 1, 0]
    out = by_id(writes.update(base, rows("id string, metadata string", ("b", '{"room":"new"}'))))
    assert (out["b"].wing, out["b"].room, out["b"].document) == (None, "new", "beta")
    assert by_id(writes.update(base, rows("id string", ("a",)))) == by_id(base)


def test_update_embeds_new_documents(base, rows):
    out = by_id(writes.update(base, rows("id string, document string", ("a", "banana toe"), ("b", None)), embedder=VowelShares()))
    assert list(out["a"].embedding) == [3.0, 1.0, 1.0]
    assert (out["b"].document, list(out["b"].embedding)) == (None, [0.0, 0.0, 0.0])
    given = rows("id string, document string, embedding array<float>", ("a", "banana", [5.0, 5.0, 5.0]))
    assert list(by_id(writes.update(base, given, embedder=VowelShares()))["a"].embedding) == [5, 5, 5]


def test_update_in_order(base, rows):
    schema = "id string, seq long, document string, set_document boolean, metadata string, set_metadata boolean"
    batch = rows(
        schema,
        ("a", 1, "first", True, None, False),
        ("a", 2, None, False, '{"wing":"z"}', True),
        ("a", 3, None, True, None, False),
    )
    row = by_id(writes.update(base, batch, seq="seq"))["a"]
    assert (row.document, row.metadata, row.wing) == (None, '{"wing":"z"}', "z")


def test_repeated_ids_without_seq(base, rows):
    plain = "id string, document string, metadata string, embedding array<float>"
    batch = rows(plain, ("n", "one", None, None), ("n", "two", None, None))
    out = writes.upsert(base, batch).collect()
    assert sorted(r.id for r in out) == ["a", "b", "n"]
    out = writes.update(base, rows("id string, document string", ("a", "one"), ("a", "two"))).collect()
    assert sorted(r.id for r in out) == ["a", "b"] and {r.document for r in out} < {"one", "two", "beta"}


def test_updates_are_checked(rows):
    batch = rows("id string, embedding array<float>", ("a", [1.0]), ("b", [1.0, 2.0, 3.0]), (None, None))
    good, bad = writes.split_update(batch, 3)
    assert [r.id for r in good.collect()] == ["b"] and good.columns == batch.columns
    assert {r.id for r in bad.collect()} == {"a", None}


def test_null_among_ids(spark, base, rows):
    """A NULL names no row, in a list short or long and in a frame; a row without id stays."""
    every = base.unionByName(base.limit(1).selectExpr("CAST(NULL AS string) AS id", *[c for c in base.columns if c != "id"]))
    for ids in (["a", None], ["a", None, *[f"x{i}" for i in range(1500)]], rows("id string", ("a",), (None,))):
        assert {r.id for r in writes.delete(every, ids=ids).collect()} == {"b", None}
        assert [r.id for r in reads.get(every, ids=ids).collect()] == ["a"]


def test_delete(base, rows):
    assert set(by_id(writes.delete(base, ids=["a"], where={"wing": "v"}))) == {"b"}
    assert set(by_id(writes.delete(base, ids=rows("id string", ("b",))))) == {"a"}
    assert set(by_id(writes.delete(base, where={"room": "r"}))) == {"a"}  # a has no room and stays
    assert set(by_id(writes.delete(base))) == {"a", "b"}
    assert set(by_id(writes.delete(base, where={}))) == {"a", "b"}
    with pytest.raises(ValueError):
        writes.delete(base, where={"$and": []})
    with pytest.raises(NotImplementedError):
        writes.delete(base, where_document={"$contains": "x"})


def test_hot_id_is_folded_before_the_shuffle(spark):
    """A third of a batch under one id: each map task sends one row of it."""
    from pyspark.sql import functions as F

    batch = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id"))).alias("id"),
        F.col("id").cast("string").alias("document"), F.col("id").alias("seq"),
    )
    out = writes.last_per_id(writes.normalized(batch))
    assert out.count() == 20_001
    assert out.filter("id = 'hot'").first().document == "29997"
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_max_by" in before_shuffle


def test_hashed_embedder():
    embedder = HashedTextEmbedder(32)
    one, same, none = embedder.embed(["Big cat, big DOG", "dog big CAT big", " ,. "])
    assert list(one) == list(same) and not any(none)
    assert math.isclose(sum(x * x for x in one), 1.0)


class CountingEmbedder:
    """Length and vowels of a text; counts the texts it is given."""

    dim = 2

    def __init__(self, seen):
        self.seen = seen

    def embed(self, texts):
        self.seen.add(len(texts))
        return [[float(len(t)), float(sum(c in "aeiou" for c in t))] for t in texts]


def test_each_distinct_text_is_embedded_once(spark):
    stored = with_promoted(spark.createDataFrame([("old", "kept", "{}", [9.0, 9.0]), ("new", "a text", "{}", [1.0, 1.0])], "id string, document string, metadata string, embedding array<float>"))
    batch = spark.createDataFrame(
        [(f"c{k}", "hot text") for k in range(300)] + [("x", None), ("y", ""), ("z", "other")], "id string, document string"
    )
    seen = spark.sparkContext.accumulator(0)
    rows = {r.id: list(r.embedding) for r in writes.upsert(stored.select(COLLECTION_SCHEMA.names), batch, embedder=CountingEmbedder(seen)).collect()}
    assert len(rows) == 305 and seen.value == 3
    assert rows["c7"] == [8.0, 2.0] and rows["x"] == rows["y"] == [0.0, 0.0] and rows["old"] == [9.0, 9.0]

    seen = spark.sparkContext.accumulator(0)
    changes = spark.createDataFrame([("old", None, False), ("new", "same", True), ("new2", "same", True)], "id string, document string, set_document boolean")
    found = {r.id: (r.document, list(r.embedding)) for r in writes.update(stored.select(COLLECTION_SCHEMA.names), changes, embedder=CountingEmbedder(seen)).collect()}
    assert found == {"old": ("kept", [9.0, 9.0]), "new": ("same", [4.0, 2.0])} and seen.value == 1


def test_the_embedder_keeps_few_words_and_gets_few_texts(spark, monkeypatch):
    """As many different words as a large corpus has don't stay in the worker, nor do its vectors change."""
    from loomstead.operators import embedding
    from pyspark.sql import functions as F

    texts = [" ".join(f"w{k}x{n}" for k in range(500)) for n in range(250)] + ["y" * 1000]
    embedder = HashedTextEmbedder(16)
    vectors = embedder.embed(texts)
    assert len(embedder._slots) == embedder._slots.most < 125_000 and "y" * 1000 not in embedder._slots
    assert (embedder.embed(texts[-2:]) == vectors[-2:]).all() and (HashedTextEmbedder(16).embed(texts[-2:]) == vectors[-2:]).all()

    class Counting:
        dim = 1

        def embed(self, texts):
            return [[float(len(texts))] for _ in texts]

    monkeypatch.setattr(embedding, "EMBED_TEXTS", 3)
    given = spark.range(8).repartition(1).selectExpr("CASE WHEN id <> 4 THEN CAST(id AS string) END AS document")
    found = given.select("document", embedding.embedding_of(Counting(), F.col("document")).alias("v")).collect()
    assert all((r.v is None) == (r.document is None) for r in found)
    assert sorted(r.v[0] for r in found if r.v) == [1.0, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0]
