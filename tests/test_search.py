import numpy as np
import pytest
from loomstead.functions.vectors import cosine_distance, from_text, mean_pool, to_text
from loomstead.operators import cells, embedding, search
from loomstead.operators.embedding import HashedTextEmbedder

DIM = 8


def table(spark, vectors, wings=None):
    data = [
        (f"r{i:04d}", f"doc {i}", '{"wing":"%s"}' % ("even" if i % 2 == 0 else "odd"), None if v is None else [float(x) for x in v])
        for i, v in enumerate(vectors)
    ]
    return spark.createDataFrame(data, "id string, document string, metadata string, embedding array<float>")


def brute(vectors, queries, k, keep=lambda i: True):
    out = {}
    for q, query in enumerate(queries):
        found = []
        for i, v in enumerate(vectors):
            if v is None or not np.any(v) or not keep(i):
                continue
            v, w = np.asarray(v, dtype=np.float32).astype(float), np.asarray(query, dtype=float)
            found.append((round(1 - v @ w / (np.linalg.norm(v) * np.linalg.norm(w)), 9), f"r{i:04d}"))
        out[q] = [name for _, name in sorted(found)[:k]]
    return out


def asked(spark, queries):
    return spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(queries)], "query_id long, embedding array<double>")


def got(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.id)
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    made = [v for v in rng.normal(size=(300, DIM)).astype(np.float32)]
    for i in range(0, 300, 3):  # a third of the rows are copies of one vector
        made[i] = made[0]
    made[4], made[5] = None, np.zeros(DIM)
    return made


@pytest.fixture(scope="module")
def questions(vectors):
    return [vectors[0], *np.random.default_rng(8).normal(size=(6, DIM))]


@pytest.mark.parametrize("k", [1, 7, 150, 500])
def test_exact_with_copies(spark, vectors, questions, k):
    expected = brute(vectors, questions, k)
    df, q = table(spark, vectors).repartition(5), asked(spark, questions)
    assert got(search.query(df, q, k, include=["distances"])) == expected
    blocked = search.query(df, q, k, include=["distances"], matrix_queries=2, block_rows=4)
    assert got(blocked) == expected


def test_filter_comes_before_ranking(spark, vectors, questions):
    hits = search.query(table(spark, vectors), asked(spark, questions), 9, where={"wing": "odd"})
    assert got(hits) == brute(vectors, questions, 9, lambda i: i % 2 == 1)


def test_small_batches(spark, vectors, questions):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert got(search.query(table(spark, vectors), asked(spark, questions), 7)) == brute(vectors, questions, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_queries(spark, vectors):
    assert search.query(table(spark, vectors), asked(spark, []), 3).count() == 0


def test_query_without_direction(spark, vectors):
    assert search.query(table(spark, vectors), asked(spark, [np.zeros(DIM)]), 3).count() == 0


def test_include(spark, vectors, questions):
    df, q = table(spark, vectors), asked(spark, questions)
    assert search.query(df, q).columns == ["query_id", "rank", "id", "distance", "document", "metadata"]
    assert search.query(df, q, include=["embeddings"]).columns == ["query_id", "rank", "id", "embedding"]
    with pytest.raises(NotImplementedError):
        search.query(df, q, where_document={"$contains": "x"})


def test_rows_of_another_width_have_no_distance(spark, vectors):
    assert search.query(table(spark, vectors), asked(spark, [[1.0, 2.0]]), 3).collect() == []


def test_nested_result(spark, vectors, questions):
    hits = search.query(table(spark, vectors), asked(spark, questions), 4)
    rows = {r.query_id: r for r in search.nested_result(hits).collect()}
    expected = brute(vectors, questions, 4)
    assert {q: r.ids for q, r in rows.items()} == expected
    assert all(r.distances == sorted(r.distances) and len(r.documents) == 4 for r in rows.values())


def test_text_query(spark):
    docs = ["red apples and pears", "blue ocean water", "apples red", "quiet ocean"]
    data = [(str(i), d, "{}") for i, d in enumerate(docs)]
    notes = spark.createDataFrame(data, "id string, document string, metadata string")
    embedder = HashedTextEmbedder(64)
    notes = embedding.embed_documents(notes, embedder)
    texts = spark.createDataFrame([(1, "red apples"), (2, "ocean")], "query_id long, text string")
    hits = search.query_texts(notes, texts, embedder, n_results=2)
    assert got(hits) == {1: ["2", "0"], 2: ["3", "1"]}


def test_documents_stay_out_of_python(spark, vectors, questions):
    plan = search.query(table(spark, vectors), asked(spark, questions), 3)._jdf.queryExecution().optimizedPlan().toString()
    python = plan[plan.index("MapInArrow"):]
    assert "document" not in python.split("+-", 2)[1]
    assert "Cartesian" not in plan and "Cross" not in plan


def test_cosine_distance(rows):
    df = rows(
        "a array<float>, b array<float>",
        ([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [-3.0, 0.0]),
        ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0]), (None, [1.0, 0.0]),
    )
    found = [r.d for r in df.select(cosine_distance("a", "b").alias("d")).collect()]
    assert found == [0.0, 1.0, 2.0, None, None, None]


def test_text_round_trip(rows):
    df = rows("v array<float>", ([0.1, -2.5e-8, 3.0],), ([float("nan"), float("inf"), 1.0],), (None,))
    back = [r.v for r in df.select(from_text(to_text("v")).alias("v")).collect()]
    assert back[0] == df.first().v and back[1] == [0.0, 0.0, 1.0] and back[2] is None


def test_mean_pool_against_numpy(rows):
    rng = np.random.default_rng(3)
    tokens, mask = rng.normal(size=(6, 4)), [1, 1, 0, 1, 0, 0]
    df = rows("tokens array<array<float>>, mask array<int>", (tokens.tolist(), mask), (tokens.tolist(), [0] * 6))
    one, none = [r.v for r in df.select(mean_pool("tokens", "mask", 4).alias("v")).collect()]
    m = np.asarray(mask, dtype=float)[:, None]
    mean = (tokens.astype(np.float32) * m).sum(0) / np.clip(m.sum(), 1e-9, None)
    assert np.allclose(one, mean / np.linalg.norm(mean)) and none == [0.0] * 4


def test_parity(rows):
    left = rows("id string, embedding array<float>", ("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("only", [1.0, 1.0]))
    right = rows("id string, embedding array<float>", ("a", [2.0, 0.0]), ("b", [1.0, -1.0]))
    row = embedding.embedding_parity(left, right).first()
    assert (row.pairs, row.min_cosine, row.max_cosine) == (2, 0.0, 1.0)



def _clustered(n, clusters, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return (centres[rng.integers(0, clusters, n)] + 0.05 * rng.normal(size=(n, dim))).astype(np.float32)


def test_cells_lose_nothing_and_prune(spark):
    """Clusters, a third of the rows copies of one vector, rows of another width: the cells give
    what brute force gives, and a query visits few of them."""
    made = list(_clustered(1200, 30))
    for i in range(0, 1200, 3):
        made[i] = made[0]
    made[7] = np.ones(5, np.float32)
    questions = [*_clustered(40, 30)[:40], np.asarray(made[0]), np.random.default_rng(1).normal(size=16)]
    expected = brute([None if len(v) == 5 else v for v in made], questions, 9)
    df, q = table(spark, made).repartition(5), asked(spark, questions)
    assert got(search.query(df, q, 9, include=["distances"], matrix_queries=1, block_rows=50)) == expected

    rows, known = cells.make_cells(df.filter("size(embedding) = 16"))
    assert rows.count() == 1199 and known.counts.sum() == 1199
    near = cells.chords(np.array([x / np.linalg.norm(x) for x in questions[:40]]), known.pivots)
    worst = np.array([brute_distance(made, x, 9) for x in questions[:40]])
    later = cells.Cells.others(known, near, np.sqrt(2 * (worst + 2e-9)), 9)
    visited = sum(known.counts[np.concatenate([a, b])].sum() for a, b in zip(known.first(near, 9), later, strict=True))
    assert visited < 0.5 * 40 * 1199  # most rows are never compared


def brute_distance(vectors, query, k):
    all_ = [1 - v @ query / (np.linalg.norm(v) * np.linalg.norm(query)) for v in vectors if len(v) == len(query)]
    return sorted(all_)[k - 1]


def test_rows_of_cells_are_not_copied(spark, vectors, questions):
    """With fewer queries than a block, each row goes to one task once, whatever the cells."""
    df = table(spark, vectors).filter("embedding IS NOT NULL AND id <> 'r0005'")
    rows, known = cells.make_cells(df.select("id", "embedding"))
    assert rows.count() == rows.select("id").distinct().count() == 298
    assert len(known.pivots) == 18


def test_merge_takes_groups_of_tasks_first(spark):
    found = spark.range(0, 40_000, 1, 600).selectExpr(
        "id % 2 AS query_id", "concat('r', id) AS id", "CAST(pmod(xxhash64(id), 1000) AS double) AS distance"
    )
    hits = search.merged(found, 5)
    plain = found.toPandas().sort_values(["query_id", "distance", "id"]).groupby("query_id").head(5)
    assert [tuple(r) for r in hits.orderBy("query_id", "rank").select("query_id", "id").collect()] == list(
        zip(plain["query_id"], plain["id"], strict=True)
    )
    plan = hits._jdf.queryExecution().toString()
    assert "hashpartitioning(query_id" in plan and "_group" in plan


def test_cells_without_rows_or_queries(spark, vectors, questions):
    none = table(spark, vectors).filter("id = 'nowhere'")
    q = asked(spark, questions)
    assert search.query(none, q, 3, include=[], matrix_queries=1).count() == 0
    odd = spark.createDataFrame([("a", "", "{}", [1.0, 2.0])], "id string, document string, metadata string, embedding array<float>")
    assert search.query(odd, q, 3, include=[], matrix_queries=1).count() == 0
