"""The neighbour graph where its start is poor, and where lengths differ."""

import numpy as np
from loomstead.llm import nn_descent
from pyspark.sql import functions as F


def table_of(spark, x):
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def graph_recall(spark, x, top=20):
    """The share of the nodes' true nearest by inner product that their lists hold."""
    members, nodes = nn_descent.indexed(table_of(spark, x))
    graph = nn_descent.neighbour_graph(nodes.select("node", "vec"), len(x))
    pairs = graph.select("node", F.explode("near").alias("other")).join(members.select("node", "vec_id"), "node")
    pairs = pairs.join(members.select(F.col("node").alias("other"), F.col("vec_id").alias("near_id")), "other")
    found = {(r["vec_id"], r["near_id"]) for r in pairs.select("vec_id", "near_id").collect()}
    s = x.astype(np.float32).astype(float) @ x.astype(np.float32).astype(float).T
    np.fill_diagonal(s, -np.inf)
    best = np.argsort(-s, axis=1)[:, :top]
    return np.mean([(i, int(j)) in found for i in range(len(x)) for j in best[i]])


def test_rounds_go_on_until_lists_settle(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "LEAF", 8)
    monkeypatch.setattr(nn_descent, "TABLES", 2)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 32))
    recall = graph_recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True))
    assert recall >= 0.97


def test_one_long_vector_flattens_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((100, 32)), 15, axis=0) + 0.3 * rng.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] *= 10_000
    monkeypatch.setattr(nn_descent, "LEAF", 128)
    s = x.astype(np.float32).astype(float) @ x.astype(np.float32).astype(float).T
    np.fill_diagonal(s, -np.inf)
    found = {}
    for r in nn_descent.nearest(table_of(spark, x), "vec_id % 20 = 0").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(found[q] & set(np.argsort(-s[q])[:20].tolist())) / 20 for q in range(0, len(x), 20)]
    assert np.mean(hits) >= 0.98 and graph_recall(spark, x, 14) >= 0.9


def test_blocks_that_end_before_others(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "QUERY_BLOCK", 2)
    monkeypatch.setattr(nn_descent, "BEAM", 24)
    monkeypatch.setattr(nn_descent, "STEP", 2)
    x = np.random.default_rng(5).standard_normal((300, 8))
    found = nn_descent.nearest(table_of(spark, x), "vec_id % 20 = 0").collect()
    assert len(found) == 15 * 20


def test_blocks_stay_few_while_each_fetches_everything():
    """Eleven blocks of 51,300 vectors, three of 10,260 made 20 times the rows of five times the input."""
    few = [nn_descent._blocks(n // 20, nn_descent.QUERY_BLOCK, n) * n for n in (20_520, 102_600)]
    assert few[1] == 5 * few[0]
    assert nn_descent._blocks(10, nn_descent.QUERY_BLOCK, 200) == 1
    assert nn_descent._blocks(1 << 20, nn_descent.BLOCK, 1 << 20) == (1 << 20) // nn_descent.BLOCK
