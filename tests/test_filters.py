import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from loomstead.functions.filters import apply_where, condition, scalar_text
from loomstead.functions.metadata import with_promoted
from loomstead.operators import reads

METADATA = [
    {"wing": "a", "room": "x", "n": 1, "flag": True},
    {"wing": "a", "room": "y", "n": 2, "flag": False},
    {"wing": "b", "n": 1, "deep": {"k": "v"}},
    {"room": "x", "n": None, "ratio": 1.0},
    {},
]


@pytest.fixture(scope="module")
def notes(spark):
    data = [(f"id{i}", f"text {i}", json.dumps(m)) for i, m in enumerate(METADATA)]
    return with_promoted(spark.createDataFrame(data, "id string, document string, metadata string")).cache()


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "where, expected",
    [
        (None, 5),
        ({}, 5),
        ({"wing": "a"}, 2),
        ({"wing": "a", "room": "x"}, 1),
        ({"$and": [{"wing": "a"}, {"room": "y"}]}, 1),
        ({"$or": [{"wing": "b"}, {"room": "x"}]}, 3),
        ({"$and": []}, 5),
        ({"$and": [{}, {"wing": "a"}]}, 2),
        ({"$and": [{"wing": "a"}], "room": "ignored"}, 2),
        ({"$and": [{"wing": "a"}], "$or": [{"wing": "b"}]}, 2),
        ({"$or": [{"$and": [{"wing": "a"}, {"n": 2}]}, {"wing": "b"}]}, 2),
        ({"wing": {"$eq": "a"}}, 2),
        ({"wing": {"$eq": "a", "$ne": "a"}}, 2),
        ({"flag": True}, 1),
        ({"n": 1}, 2),
        ({"ratio": 1.0}, 1),
        ({"ratio": 1}, 0),
        ({"deep.k": "v"}, 1),
        ({"n": None}, 0),
    ],
)
def test_where(notes, where, expected):
    assert apply_where(notes, where).count() == expected


def test_scalars():
    assert [scalar_text(v) for v in (True, False, 3, 1.5, "x", None)] == ["true", "false", "3", "1.5", "x", "None"]


def test_unknown_operator():
    with pytest.raises(ValueError):
        condition({"n": {"$gt": 1}})


def test_document_filter_refused(notes):
    with pytest.raises(NotImplementedError):
        reads.get(notes, where_document={"$contains": "x"})


def test_promoted_filter_reaches_the_scan(notes, tmp_path):
    notes.write.parquet(str(tmp_path / "n"))
    stored = notes.sparkSession.read.parquet(str(tmp_path / "n"))
    plan = apply_where(stored, {"wing": "a", "n": 1})._jdf.queryExecution().toString()
    assert "EqualTo(wing,a)" in plan.split("PushedFilters")[-1]


KEYS = ["wing", "room", "n", "flag", "missing"]
LEAF = st.dictionaries(
    st.sampled_from(KEYS), st.sampled_from(["a", "b", "x", "y", 1, 2, True, False]), min_size=1, max_size=2
)
FILTER = st.recursive(
    LEAF | st.just({}),
    lambda inner: st.lists(inner, max_size=3).flatmap(
        lambda parts: st.sampled_from([{"$and": parts}, {"$or": parts}])
    ),
    max_leaves=5,
)


def holds(where, row):
    """True, False or None (unknown), and "all" for a filter without a condition."""
    if not where:
        return "all"
    for word in ("$and", "$or"):
        if word in where:
            parts = [p for p in (holds(w, row) for w in where[word]) if p != "all"]
            if not parts:
                return "all"
            decisive = word == "$or"
            if decisive in parts:
                return decisive
            return None if None in parts else not decisive
    values = []
    for key, value in where.items():
        got = row.get(key)
        values.append(None if got is None else scalar_text(got) == scalar_text(value))
    return False if False in values else None if None in values else True


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(FILTER)
def test_where_agrees_with_plain_evaluation(notes, where):
    expected = [f"id{i}" for i, m in enumerate(METADATA) if holds(where, m) in (True, "all")]
    assert ids(apply_where(notes, where)) == expected
