"""Reading and writing facts, and agreement with the calls made one by one."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from loomstead.functions import names, temporal
from loomstead.operators import fact_events, fact_reads, fact_writes, seeding
from loomstead.schemas import ENTITY_SCHEMA, TRIPLE_SCHEMA
from loomstead.session import nothing, written
from pyspark.sql import functions as F

TS = "2026-01-01 00:00:00"
FACT = "seq long, subject string, predicate string, object string, valid_from string, valid_to string"
ENDING = "seq long, subject string, predicate string, object string, ended string"
EVENT = "seq long, kind string, subject string, predicate string, object string, valid_from string, valid_to string, ended string"


@pytest.fixture()
def no_entities(spark):
    return nothing(spark, ENTITY_SCHEMA)


@pytest.fixture()
def no_triples(spark):
    return nothing(spark, TRIPLE_SCHEMA)


def start(v):
    return temporal.key_of(v)


def end(v):
    return temporal.key_of(v, temporal.DAY_END)


class Calls:
    """The calls one by one, over plain lists."""

    def __init__(self):
        self.facts, self.entities, self.outcomes = [], {}, {}

    def add(self, seq, subject, predicate, obj, valid_from=None, valid_to=None):
        if valid_from is not None and valid_to is not None and end(valid_to) < start(valid_from):
            self.outcomes[seq] = "rejected"
            return
        s, o = names.slug_of(subject), names.slug_of(obj)
        self.entities.setdefault(s, subject)
        self.entities.setdefault(o, obj)
        key = (s, names.predicate_of(predicate), o)
        if any(f["key"] == key and f["to"] is None for f in self.facts):
            self.outcomes[seq] = "existing"
            return
        self.facts.append({"key": key, "from": valid_from, "to": valid_to})
        self.outcomes[seq] = "inserted"

    def finish(self, seq, subject, predicate, obj, ended):
        key = (names.slug_of(subject), names.predicate_of(predicate), names.slug_of(obj))
        found = [f for f in self.facts if f["key"] == key and f["to"] is None]
        if any(f["from"] is not None and end(ended) < start(f["from"]) for f in found):
            self.outcomes[seq] = "rejected"
            return
        for f in found:
            f["to"] = ended
        self.outcomes[seq] = "closed" if found else "nothing open"

    def listed(self):
        return sorted((*f["key"], f["from"] or "", f["to"] or "") for f in self.facts)


def listed(triples):
    columns = ("subject", "predicate", "object", "valid_from", "valid_to")
    return sorted(tuple(r[c] or "" for c in columns) for r in triples.collect())


# -- functions ----------------------------------------------------------------------------


def test_slugs(rows):
    r = rows("n string", ("Ida O'Brook Jr",)).select(
        names.entity_slug("n").alias("e"), names.predicate_slug("n").alias("p"), names.capitalize("n").alias("c")
    ).first()
    assert tuple(r) == ("ida_obrook_jr", "ida_o'brook_jr", "Ida o'brook jr")
    assert (names.slug_of("Ida O'Brook Jr"), names.predicate_of("Is  A")) == ("ida_obrook_jr", "is__a")


def test_temporal_keys(rows):
    values = ["2026-05-06", "2026-05-06T10:00:00Z", "2026/05/06", "abcd-ef-gh", "é026-05-06", None]
    found = rows("v string", *[(v,) for v in values]).select(
        temporal.start_key("v").alias("s"), temporal.end_key("v").alias("e")
    ).collect()
    assert [r.s for r in found[:4]] == ["2026-05-06T00:00:00Z", values[1], values[2], "abcd-ef-ghT00:00:00Z"]
    assert found[0].e == "2026-05-06T23:59:59Z" and found[4].s == values[4] and found[5].s is None


@pytest.mark.parametrize(
    "text, fine",
    [("2026-01-01", True), ("2026-01-01T00:00:00Z", True), ("2026-01-01T00:00:00.5+02:00", True),
     ("2026-01", False), ("yesterday", False), ("2026-01-01 00:00:00", False), (None, True)],
)
def test_temporal_check(rows, text, fine):
    assert rows("v string", (text,)).select(temporal.is_temporal("v").alias("ok")).first().ok is fine
    if fine:
        assert temporal.check_temporal(text, "v") == text
    else:
        with pytest.raises(ValueError):
            temporal.check_temporal(text, "v")


@pytest.mark.parametrize(
    "as_of, kept",
    [("2025-12-31", ["open", "past"]), ("2026-01-01", ["day", "open", "past"]), ("2026-01-02", ["open", "past"]),
     ("2026-03-01", ["open"]), (None, ["day", "open", "past"]), ("", ["day", "open", "past"])],
)
def test_as_of(rows, as_of, kept):
    df = rows("n string, valid_from string, valid_to string",
              ("open", None, None), ("day", "2026-01-01", "2026-01-01"), ("past", "2025-01-01", "2026-02-01T00:00:00Z"))
    assert sorted(r.n for r in temporal.apply_as_of(df, as_of).collect()) == kept


# -- entities -----------------------------------------------------------------------------


def test_upsert_entities(spark, rows):
    base = fact_writes.upsert_entities(nothing(spark, ENTITY_SCHEMA), rows("name string, type string, properties string", ("Ida Brook", "person", '{"gender":"m"}')), "2025-01-01 00:00:00")
    batch = rows("seq long, name string, type string, properties string",
                 (1, "ida brook", "cat", '{"a":1}'), (2, "IDA Brook", None, None), (1, "New", None, None))
    out = {r.id: r for r in fact_writes.upsert_entities(base, batch, TS, seq="seq").collect()}
    assert set(out) == {"ida_brook", "new"}
    old = out["ida_brook"]
    assert (old.name, old.type, old.properties, old.created_at.year) == ("IDA Brook", "unknown", "{}", 2025)
    assert out["new"].created_at.year == 2026


def test_mentioned_entities(no_entities, no_triples, rows):
    batch = rows(FACT, (2, "ida", "likes", "IDA", None, None), (1, "Ida", "likes", "Cello", None, None),
                 (3, "Bad", "x", "Worse", "2026-02-01", "2026-01-01"), (4, "ida", "likes", "cello", None, None))
    out = fact_writes.add_facts(no_entities, no_triples, batch, TS)
    found = {r.id: r for r in out.entities.collect()}
    assert {k: r.name for k, r in found.items()} == {"ida": "Ida", "cello": "Cello"}
    assert found["ida"].type == "unknown" and found["ida"].properties is None
    again = fact_writes.add_facts(out.entities, out.triples, rows(FACT, (1, "IDA", "is", "Cello", None, None)), TS)
    assert {r.id: r.name for r in again.entities.collect()} == {"ida": "Ida", "cello": "Cello"}


# -- adding and ending --------------------------------------------------------------------


def test_add_defaults_and_id(no_entities, no_triples, rows):
    out = fact_writes.add_facts(no_entities, no_triples, rows("seq long, subject string, predicate string, object string", (1, "Ida", "Plays It", "cello")), TS)
    r = out.triples.first()
    assert r.id.startswith("t_ida_plays_it_cello_") and len(r.id) == len("t_ida_plays_it_cello_") + 12
    assert (r.confidence, r.source_closet, r.adapter_name, r.valid_from) == (1.0, None, None, None)


def test_existing_open_fact_is_returned(no_entities, no_triples, rows):
    first = fact_writes.add_facts(no_entities, no_triples, rows(FACT, (1, "Ida", "plays", "cello", "2025-11-07", None)), TS)
    stored = first.triples.first().id
    second = fact_writes.add_facts(first.entities, first.triples, rows(FACT, (1, "ida", "PLAYS", "Cello", "2026-01-01", "2026-02-01")), TS)
    assert [(r.status, r.fact_id) for r in second.outcomes.collect()] == [("existing", stored)]
    assert second.triples.count() == 1


def test_rejected_facts(no_entities, no_triples, rows):
    batch = rows(FACT, (1, "A", "x", "B", "2026-09-12", "2026-09-02"), (2, "A", "x", "B", "soon", None),
                 (3, None, "x", "B", None, None), (4, "A", "x", "B", "2026-09-12", "2026-09-12"))
    out = {r.seq: r for r in fact_writes.add_facts(no_entities, no_triples, batch, TS).outcomes.collect()}
    assert [out[i].status for i in (1, 2, 3, 4)] == ["rejected"] * 3 + ["inserted"]
    assert out[1].reason == "the interval ends before it starts" and out[1].fact_id is None


def test_invalidate(no_entities, no_triples, rows):
    facts = fact_writes.add_facts(no_entities, no_triples, rows(FACT,
        (1, "Ida", "owns_boat", "skiff", "2025-01-01", None), (2, "Ida", "plays", "cello", "2025-06-01", None),
        (3, "Ida", "is", "old", None, "2024-01-01")), TS).triples
    ends = rows(ENDING, (1, "Ida", "owns boat", "Skiff", "2026-08-21"), (2, "Ida", "plays", "cello", "2025-05-01"),
                (3, "Ida", "plays", "cello", "later"), (4, "Ida", "is", "old", "2025-01-01"))
    out = fact_writes.invalidate(facts, ends)
    assert {r.predicate: r.valid_to for r in out.triples.collect()} == {
        "owns_boat": "2026-08-21", "plays": None, "is": "2024-01-01"}
    assert {r.seq: r.reason.split(" is ")[0] for r in out.rejects.collect()} == {2: "the interval ends before it starts", 3: "ended"}


def test_invalidate_closes_all_or_nothing(spark, rows):
    data = [(f"f{i}", "a", "p", "b", v, None, 1.0, None, None, None, None, None) for i, v in enumerate(["2025-01-01", "2025-03-01", None])]
    facts = spark.createDataFrame(data, TRIPLE_SCHEMA)
    refused = fact_writes.invalidate(facts, rows(ENDING, (1, "A", "p", "B", "2025-02-01")))
    assert refused.rejects.count() == 1 and refused.triples.filter("valid_to IS NULL").count() == 3
    done = fact_writes.invalidate(facts, rows(ENDING, (1, "A", "p", "B", "2025-02-01"), (2, "A", "p", "B", "2025-04-01"), (3, "A", "p", "B", "2025-01-01")))
    assert [r.seq for r in done.rejects.collect()] == [1]  # the third finds nothing open
    assert {r.valid_to for r in done.triples.collect()} == {"2025-04-01"}


def test_invalidate_defaults_to_today(no_entities, no_triples, rows):
    facts = fact_writes.add_facts(no_entities, no_triples, rows(FACT, (1, "A", "p", "B", None, None)), TS).triples
    out = fact_writes.invalidate(facts, rows("seq long, subject string, predicate string, object string", (1, "A", "p", "B")), today="2026-03-04")
    assert out.triples.first().valid_to == "2026-03-04"


def test_a_small_batch_leaves_the_entities_where_they_lie(spark, rows, tmp_path):
    stored = spark.range(2000).selectExpr(
        "concat('e', id) AS id", "concat('E', id) AS name", "'t' AS type", "CAST(NULL AS STRING) AS properties", "timestamp'2025-01-01 00:00:00' AS created_at"
    )
    stored.write.parquet(str(tmp_path / "entities"))
    stored = spark.read.schema(ENTITY_SCHEMA).parquet(str(tmp_path / "entities"))
    renamed = fact_writes.upsert_entities(stored, written(rows("name string, type string", ("E7", "other"), ("Newcomer", None))), TS)
    found = {r.id: (r.name, r.type, str(r.created_at)[:4]) for r in renamed.collect()}
    assert len(found) == 2001 and found["e7"] == ("E7", "other", "2025") and found["e8"] == ("E8", "t", "2025") and found["newcomer"][1] == "unknown"
    facts = fact_writes.keyed(written(rows(FACT, (1, "e9", "p", "Someone", None, None))))
    grown = fact_writes.add_mentioned(stored, facts, TS)
    assert {r.id for r in grown.collect()} - {r.id for r in stored.collect()} == {"someone"}
    for df in (renamed, grown):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "FullOuter" not in plan


DATES = [None, "2025-01-01", "2025-02-01", "2025-02-01T12:00:00Z", "2025-03-01", "2025-04-01"]
ADDS = st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from(DATES), st.sampled_from(DATES)), max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ADDS, ADDS)
def test_batches_equal_single_calls(spark, no_entities, no_triples, first, second):
    calls, entities, triples = Calls(), no_entities, no_triples
    for batch in (first, second):
        calls.outcomes = {}
        data = [(i, s, "p", "x", a, b) for i, (s, a, b) in enumerate(batch)]
        for row in data:
            calls.add(*row)
        df = spark.createDataFrame(random.Random(1).sample(data, len(data)), FACT)
        out = fact_writes.add_facts(entities, triples, df, TS)
        assert {r.seq: r.status for r in out.outcomes.collect()} == calls.outcomes
        assert listed(out.triples) == calls.listed()
        entities, triples = out.entities, out.triples
    assert {r.id: r.name for r in entities.collect()} == calls.entities


# -- mixed sequences ----------------------------------------------------------------------

EVENTS = st.lists(
    st.tuples(st.booleans(), st.sampled_from("AB"), st.sampled_from(DATES), st.sampled_from(DATES)), max_size=60
)


@settings(max_examples=300, deadline=None)
@given(EVENTS, st.integers(1, 70))
def test_chunks_chain_like_one_run(events, span):
    """Summing up, chaining and replaying chunks gives what following all events gives."""
    mine = []
    for i, (adding, key, a, b) in enumerate(events):
        if key == "A":
            kind = ("open" if b is None else "closed") if adding else "end"
            mine.append((kind, f"f{i}", start(a or "") if adding else end(a or "2025-01-15")))
    whole, last = fact_events.follow(mine, None)
    state, pieces, so_far = None, [], None
    for at in range(0, len(mine), span):
        chunk = mine[at : at + span]
        outcomes, after = fact_events.follow(chunk, state)
        summary = fact_events.summarize(chunk)
        assert fact_events.chain(summary, state) == after
        so_far = fact_events.compose(so_far, summary) if at else summary
        assert fact_events.chain(so_far, None) == after
        for entered in (None, *[fact_events.Open("e", start(d or "")) for d in DATES]):
            assert fact_events.chain(so_far, entered) == fact_events.follow(mine[: at + span], entered)[1]
        pieces, state = pieces + outcomes, after
    assert (pieces, state) == (whole, last)


def stored_facts(spark, calls):
    """Two open facts of one key, which only a load from elsewhere can leave, and others."""
    data = [("s1", "hot", "2025-02-01", None), ("s2", "hot", None, None), ("s3", "s_1", "2025-01-01", "2025-01-05"), ("s4", "s_2", "2025-03-01", None)]
    for _, subject, a, b in data:
        calls.facts.append({"key": (subject, "likes", "it"), "from": a, "to": b})
    rows = [(i, s, "likes", "it", a, b, 1.0, None, None, None, None, None) for i, s, a, b in data]
    return spark.createDataFrame(rows, TRIPLE_SCHEMA)


@pytest.mark.parametrize("span,fan_in,gap", [(1, 2, 1), (7, 2, 1_000_000), (3, 64, 1), (1000, 64, 1)])
def test_mixed_events_equal_single_calls(spark, no_entities, span, fan_in, gap):
    random.seed(span)
    calls, data = Calls(), []
    stored = stored_facts(spark, calls)
    n = 90 if fan_in == 2 else 400
    for seq in range(0, n * gap, gap):
        subject = "Hot" if random.random() < 0.4 else f"S {random.randrange(30)}"
        a, b = random.choice(DATES), random.choice([None, None, *DATES])
        if random.random() < 0.6:
            calls.add(seq, subject, "Likes", "it", a, b)
            data.append((seq, "add", subject, "Likes", "it", a, b, None))
        else:
            ended = a or "2025-02-15"
            calls.finish(seq, subject, "Likes", "it", ended)
            data.append((seq, "end", subject, "Likes", "it", None, None, ended))
    random.shuffle(data)
    early = spark.createDataFrame([d for d in data if d[0] < n // 3 * gap], EVENT)
    late = spark.createDataFrame([d for d in data if d[0] >= n // 3 * gap], EVENT)
    one = fact_events.apply_events(no_entities, stored, early, TS, span, fan_in=fan_in)
    two = fact_events.apply_events(one.entities, one.triples, late, "2026-02-02 00:00:00", span, fan_in=fan_in)
    outcomes = {r.seq: r.status for r in one.outcomes.unionByName(two.outcomes).collect()}
    assert outcomes == calls.outcomes
    assert listed(two.triples) == calls.listed()
    assert {r.id: r.name for r in two.entities.collect()} == calls.entities


def test_no_task_follows_a_hot_key_alone(spark):
    """Of 2,000 chunks of one key no more than the fan-in meet in a group, on every level."""
    chunks = spark.range(2000).selectExpr("id AS chunk", "'k' AS key")
    summary = chunks.selectExpr("*", "CAST(NULL AS STRUCT<id: STRING, start: STRING>) AS none", "array(struct('9' AS bar, CAST(NULL AS STRUCT<id: STRING, start: STRING>) AS out)) AS steps")
    stored = spark.createDataFrame([("k", ("f", "1"))], "key string, stored struct<id: string, start: string>")
    seen = spark.sparkContext.accumulator(0)
    chain_sorted = fact_events._chain_sorted

    def counted(batches):
        group = None
        for pdf in batches:
            sizes = pdf.groupby(["key", "block"]).size()
            seen.add(int(sizes.max()) if len(sizes) and sizes.max() > 8 else 0)
            group = pdf if group is None else group
            yield from chain_sorted(iter([pdf]))

    fact_events._chain_sorted = counted
    try:
        found = fact_events.entry_states(summary, stored, 2000, fan_in=8).collect()
    finally:
        fact_events._chain_sorted = chain_sorted
    assert [(r.chunk, r.open_id) for r in found] == [(0, "f")]  # the first chunk ends the fact
    assert seen.value == 0


def test_chunks_follow_the_rank_of_seq(spark):
    events = spark.range(1000).selectExpr("id * id * 1000000 - 5 AS seq")
    found, n = fact_events.chunked(events, 30)
    rows = sorted((r.seq, r.chunk) for r in found.collect())
    assert [c for _, c in rows] == sorted(c for _, c in rows)
    sizes = [sum(c == k for _, c in rows) for k in range(n)]
    assert sum(sizes) == 1000 and max(sizes) <= 30 and min(sizes) > 0 and n <= 1000 // 30 + 5


# -- reading ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def graph(spark):
    data = [
        (1, "Ida", "plays", "Cello", "2025-11-07", None),
        (2, "Ida", "plays", "Ida", "2025-01-01", "2025-02-01"),
        (3, "Ann", "knows", "Ida", None, None),
        (4, "Ann", "knows", "Ghost", "2024-01-01", None),
    ]
    out = fact_writes.add_facts(nothing(spark, ENTITY_SCHEMA), nothing(spark, TRIPLE_SCHEMA), spark.createDataFrame(data, FACT), TS)
    return out.entities.filter("id <> 'ghost'").cache(), out.triples.cache()


def shown(df):
    return sorted((r.subject, r.predicate, r.object) for r in df.collect())


def test_query_entity(graph):
    out = fact_reads.query_entity(*graph, "IDA")
    assert out.columns == ["direction", "subject", "predicate", "object", "valid_from", "valid_to", "confidence", "source_closet", "current"]
    assert shown(out) == [("IDA", "plays", "Cello"), ("IDA", "plays", "Ida")]
    assert shown(fact_reads.query_entity(*graph, "ida", direction="incoming")) == [("Ann", "knows", "ida"), ("Ida", "plays", "ida")]
    assert fact_reads.query_entity(*graph, "Ida", direction="both").count() == 4  # the loop twice
    assert fact_reads.query_entity(*graph, "Ida", direction="sideways").count() == 0
    assert fact_reads.query_entity(*graph, "Ida", as_of="2025-01-15", direction="both").count() == 3
    assert fact_reads.query_entity(*graph, "Ida", as_of="").count() == 2
    with pytest.raises(ValueError):
        fact_reads.query_entity(*graph, "Ida", as_of="soon")
    current = {r.object: r.current for r in fact_reads.query_entity(*graph, "Ida").collect()}
    assert current == {"Cello": True, "Ida": False}


AS_OF = [None, "", "1700-01-01", "2024-12-31", "2025-01-01", "2025-02-01T11:00:00Z", "2025-02-01T13:00:00+01:00", "2025-02-28", "2025-04-01", "2999-01-01"]


@pytest.mark.parametrize("hot", [(1, 1), (10_000, 1)])
def test_many_probes_by_slabs_equal_single_lookups(spark, monkeypatch, hot):
    monkeypatch.setattr(fact_reads, "HOT_FACTS", hot[0])
    monkeypatch.setattr(fact_reads, "HOT_PROBES", hot[1])
    random.seed(4)
    ends = [*DATES, "2025-02-30", "soon", "1500-01-01", "2500-06-01"]
    data = [
        (f"f{k}", random.choice(["ida", "ann"]), "p", random.choice(["ida", "bo", "ghost"]), random.choice(ends), random.choice(ends), 1.0, None, None, None, None, None)
        for k in range(120)
    ]
    triples = spark.createDataFrame(data, TRIPLE_SCHEMA).cache()
    entities = spark.createDataFrame([(i, n, None, None, None) for i, n in (("ida", "Ida"), ("ann", "Ann"), ("bo", "Bo"))], ENTITY_SCHEMA)
    probes = [(name, as_of) for name in ("Ida", "ann", "Bo", "Nobody") for as_of in AS_OF]
    asked = spark.createDataFrame(probes, "name string, as_of string")
    columns = ["direction", "subject", "predicate", "object", "valid_from", "valid_to"]
    found = fact_reads.query_entities(entities, triples, asked, "both").select("as_of", *columns).collect()
    expected = [(as_of, r) for name, as_of in probes for r in fact_reads.query_entity(entities, triples, name, as_of, "both").select(*columns).collect()]
    assert sorted((str(r[0]), *map(str, r[1:])) for r in found) == sorted((str(a), *map(str, r)) for a, r in expected)


@pytest.mark.parametrize("direction", ["both", "outgoing", "incoming"])
def test_totals_equal_counted_lookups(spark, direction):
    """Entities that share their times, one with a time twice, one with times of its own; facts
    without start, end, confidence or subject; ends that are no dates."""
    random.seed(5)
    ends = [*DATES, "2025-02-30", "soon", "1500-01-01", "2500-06-01"]
    data = [
        (f"f{k}", random.choice(["ida", "ann", None]), random.choice("pq"), random.choice(["ida", "bo", "ghost"]), random.choice(ends), random.choice(ends), random.choice([0.5, 0.25, None]), None, None, None, None, None)
        for k in range(120)
    ]
    triples = spark.createDataFrame(data, TRIPLE_SCHEMA).cache()
    entities = spark.createDataFrame([(i, n, None, None, None) for i, n in (("ida", "Ida"), ("ann", "Ann"), ("bo", "Bo"), ("bo", "B'o"))], ENTITY_SCHEMA)
    probes = [(name, as_of) for name in ("Ida", "ann", "Nobody", "Bo", "b'o", None) for as_of in AS_OF] + [("Ida", "2025-01-01"), ("ghost", "2025-04-01")]
    asked = spark.createDataFrame(probes, "name string, as_of string")
    by = ["predicate", "as_of"] if direction == "outgoing" else ["direction", "predicate", "as_of"]
    pairs = fact_reads.query_entities(entities, triples, asked, direction)
    expected = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.sum("confidence").alias("confidence")).collect()
    found = fact_reads.totals_as_of(entities, triples, asked, direction).select(*by, "n", "confidence").collect()
    assert sorted(map(str, found)) == sorted(map(str, expected)) and expected


def test_totals_meet_the_times_as_counts(spark):
    """A fact that 50 names share, asked for 40 times each: one count, not 50 x 40 pairs."""
    triples = spark.range(50).selectExpr("concat('f', id) AS id", "concat('e', id) AS subject", "'p' AS predicate", "'o' AS object", "'2025-01-01' AS valid_from", "CAST(NULL AS STRING) AS valid_to", "1D AS confidence")
    entities = spark.createDataFrame([("o", "o")], "id string, name string")
    probes = spark.range(50).selectExpr("concat('e', id) AS name", "explode(array_repeat('2025-06-01', 40)) AS as_of")
    met = []

    def meeting(facts, asked, pairs=fact_reads._valid_pairs):
        met.append((facts.count(), asked.count()))
        return pairs(facts, asked)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fact_reads, "_valid_pairs", meeting)
        assert [tuple(r) for r in fact_reads.totals_as_of(entities, triples, probes).collect()] == [("p", "2025-06-01", 2000, 2000.0)]
    assert met == [(1, 1)]


def test_slabs_test_little_more_than_what_they_find(spark):
    """A hot entity with short facts: an equi join would test 200 pairs for each one found."""
    facts = spark.range(20_000).selectExpr(
        "'e' AS _here", "CAST(date_add(DATE'2000-01-01', CAST(id % 2000 AS INT)) AS STRING) AS valid_from",
        "CAST(date_add(DATE'2000-01-01', CAST(id % 2000 + 3 + id % 11 AS INT)) AS STRING) AS valid_to",
    )
    asked = spark.range(300).selectExpr("'e' AS _here", "concat(CAST(date_add(DATE'2000-01-05', CAST(id * 6 AS INT)) AS STRING), 'T00:00:00Z') AS _key")
    pairs = fact_reads.slab_pairs(facts, asked.withColumn("_day", F.expr(fact_reads._day("_key")))).cache()
    returned = facts.join(asked, "_here").filter(temporal.valid_at("_key")).count()
    assert pairs.filter(temporal.valid_at("_key")).count() == returned
    assert returned <= pairs.count() <= 1.2 * returned


def test_query_entities_equals_single_lookups(graph, rows):
    probes = [("Ida", "2025-01-15"), ("Ida", "2026-01-01"), ("Ann", None), ("Nobody", "2025-01-01")]
    found = fact_reads.query_entities(*graph, rows("name string, as_of string", *probes)).collect()
    got = sorted((r.subject, r.as_of or "", r.object) for r in found)
    expected = sorted(
        (r.subject, as_of or "", r.object) for name, as_of in probes
        for r in fact_reads.query_entity(*graph, name, as_of).collect()
    )
    assert got == expected and got


def test_query_relationship(graph):
    assert shown(fact_reads.query_relationship(*graph, "Knows")) == [("Ann", "knows", "Ida")]
    assert fact_reads.query_relationship(*graph, "plays", "2025-01-15").count() == 1


def test_timeline(graph):
    out = [(r.subject, r.object) for r in fact_reads.timeline(*graph).collect()]
    assert out == [("Ida", "Ida"), ("Ida", "Cello"), ("Ann", "Ida")]  # unknown start last
    assert [r.object for r in fact_reads.timeline(*graph, "Ann").collect()] == ["Ida"]


@pytest.mark.parametrize("missing", [0, 30, 90])
def test_timeline_survives_missing_entities(spark, no_entities, no_triples, missing):
    data = [(i, f"S{i:03d}", "p", "o", f"2025-01-01T00:00:{i % 60:02d}Z" if i < 60 else None, None) for i in range(120)]
    out = fact_writes.add_facts(no_entities, no_triples, spark.createDataFrame(data, FACT), TS)
    kept = out.entities.filter(~F.col("id").isin([f"s{i:03d}" for i in range(missing)]) | (F.col("id") == "o"))
    found = [r.subject for r in fact_reads.timeline(kept, out.triples, limit=5).collect()]
    live = [d for d in data if d[0] >= missing]
    triples = {r.subject: r.id for r in out.triples.collect()}
    expected = sorted(live, key=lambda d: (d[4] is None, d[4] or "", triples[d[1].lower()]))[:5]
    assert found == [d[1] for d in expected]


def test_stats(graph):
    row = fact_reads.stats(*graph).first().asDict()
    assert row == {"entities": 3, "triples": 4, "current_facts": 3, "expired_facts": 1, "relationship_kinds": 2}
    assert [r.predicate for r in fact_reads.predicates(graph[1]).collect()] == ["knows", "plays"]
    spark = graph[0].sparkSession
    empty = fact_reads.stats(nothing(spark, ENTITY_SCHEMA), nothing(spark, TRIPLE_SCHEMA)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


# -- seeding ------------------------------------------------------------------------------

PERSON = ("seq long, key string, full_name string, type string, gender string, birthday string, parent string, "
          "partner string, relationship string, sibling string, owner string, interests array<string>")


def test_seed(no_entities, no_triples, rows):
    records = rows(
        PERSON,
        (1, "ida", "Ida Brook", None, "m", "2010-04-01", "ann LEE", None, "daughter", None, None, ["cello", "go"]),
        (2, "ann lee", None, "adult", None, None, None, "BOB", "husband", None, None, None),
        (3, "bob", None, None, None, None, "", None, "brother", "ann lee", None, []),
        (4, "rex", None, None, None, None, None, None, "dog", None, "ida", None),
        (5, "mia", None, None, None, None, None, None, "daughter", None, None, None),
        (6, "tom", "Tom Fox", None, None, None, None, None, "husband", None, None, None),
    )
    out = seeding.seed(no_entities, no_triples, records, TS)
    facts = sorted((r.subject, r.predicate, r.object, r.valid_from) for r in out.triples.collect())
    assert facts == sorted([
        ("ida_brook", "child_of", "ann_lee", "2010-04-01"), ("ida_brook", "is_child_of", "ann_lee", "2010-04-01"),
        ("ida_brook", "loves", "cello", "2025-01-01"), ("ida_brook", "loves", "go", "2025-01-01"),
        ("ann_lee", "married_to", "bob", None), ("ann_lee", "is_partner_of", "bob", None),
        ("bob", "is_sibling_of", "ann_lee", None), ("rex", "is_pet_of", "ida", None),
        ("mia", "is_child_of", "mia", None), ("tom_fox", "is_partner_of", "tom_fox", None),
    ])
    entities = {r.id: r for r in out.entities.collect()}
    assert (entities["ida_brook"].name, entities["ida_brook"].type) == ("Ida Brook", "person")
    assert entities["ida_brook"].properties == '{"gender":"m","birthday":"2010-04-01"}'
    assert (entities["ann_lee"].name, entities["ann_lee"].type) == ("Ann lee", "adult")
    assert (entities["rex"].type, entities["rex"].properties) == ("animal", "{}")
    assert (entities["cello"].name, entities["cello"].type, entities["cello"].properties) == ("Cello", "unknown", None)


def test_person_records_are_dealt_out_before_they_are_expanded(spark, tmp_path):
    """One small file, joined to smaller tables: adaptive execution alone would leave one task."""
    from loomstead.plans import inputs

    spark.sql("SELECT 1L AS r_regionkey, 'r' AS r_name").selectExpr("CAST(r_regionkey AS int) r_regionkey", "r_name").write.parquet(f"{tmp_path}/region.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(400).selectExpr(
        "id AS c_custkey", "concat('C', id) AS c_name", "1 AS c_nationkey", "9000D AS c_acctbal", "'BUILDING' AS c_mktsegment"
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    parts = inputs.people(inputs.Tables(spark, str(tmp_path))).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == spark.sparkContext.defaultParallelism and sum(r["count"] for r in parts) == 400


def test_a_batch_is_folded_without_sorting(spark, no_triples, rows):
    """Texts in the fold would sort all of the batch by key first."""
    batch = rows(FACT, (1, "a", "p", "b", None, None), (2, "a", "p", "b", None, None))
    judgement = fact_writes.judged(no_triples, batch, TS)
    assert "SortAggregate" not in judgement._jdf.queryExecution().sparkPlan().toString()
    ids = {r.seq: (r.status, r.fact_id) for r in judgement.collect()}
    assert ids[1][0] == "inserted" and ids[2] == ("existing", ids[1][1])
