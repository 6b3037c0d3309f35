"""Orchard search against comparing every centroid, and the clustering against its SQL."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from loomstead.llm import orchard_clusters, queries
from oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    sql = queries.ORACLES["op11_orchard_clusters"]
    assert difference(connect(FOLDER), sql, queries.QUERIES["op11_orchard_clusters"](spark, FOLDER)) is None


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 12), st.integers(1, 4), st.integers(1, 5))
def test_search_finds_the_nearest_with_ties(seed, k, dim, spread):
    rng = np.random.default_rng(seed)
    centroids, vectors = rng.integers(-spread, spread + 1, (k, dim)), rng.integers(-spread, spread + 1, (50, dim))
    best, near, _ = orchard_clusters.search(orchard_clusters.model_of(centroids), vectors, int(rng.integers(k)))
    apart = np.square(vectors[:, None] - centroids[None]).sum(2)
    assert (best == apart.argmin(1)).all() and (near == apart.min(1)).all()


def test_search_leaves_out_far_centroids():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-(2**20), 2**20, (200, 8))
    vectors = centroids[rng.integers(200, size=2000)] + rng.integers(-500, 500, (2000, 8))
    best, _, looked = orchard_clusters.search(orchard_clusters.model_of(centroids), vectors)
    assert (best == np.square(vectors[:, None] - centroids[None]).sum(2).argmin(1)).all()
    assert looked.mean() < 100


def lloyd(rows, k, rounds):
    kept = [(i, [int(np.floor(float(np.float32(x)) * 256)) for x in v]) for i, v in rows]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for _, j, _ in found}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in found), key=str)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [
        (1, [0.5, -0.3]), (1, [0.5, -0.3]), (1, [0.1, 0.0]), (None, [9.0, 9.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0]),
        (4, [8.0, 8.5]), (5, [-7.0, 1000.0]), (6, [-0.001, 0.001]),
    ]
    bad = [(7, None), (8, [1.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, []), (13, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").selectExpr("*", "0 AS cluster", "'x' AS q", "1 AS distance")
    for k in (1, 3, 40):
        found = orchard_clusters.clustered(vectors, 2, k, 3)
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted((tuple(r) for r in found.collect()), key=str) == lloyd(good, k, 3)
    assert orchard_clusters.clustered(vectors.filter("vec_id > 6"), 2).collect() == []
    with pytest.raises(Exception, match="not below"):
        orchard_clusters.clustered(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<float>"), 2).collect()
