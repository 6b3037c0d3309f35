"""Centroid clustering in exact integers, each vector's nearest centroid found by Orchard search.

Every centroid has the list of the other centroids by distance from it. The search for a
vector starts at some centroid and walks its list; as soon as one nearer to the vector turns
up, it goes on with that one's list from the start, leaving out the centroids seen before. An
entry of the list further than twice the present distance away lies strictly further from the
vector than the present centroid, and so do all entries after it: there the search stops. At
exactly twice the distance an entry may still tie and have the smaller number, so it is looked at.

The lists depend on the centroids alone and travel with them. Rows are searched side by side
in an Arrow batch; a task hands on one row of sums per centroid, whatever it has read, so the
driver sees ``clusters`` rows a round and no vector.

Components are ``floor(256 * x)``; all sums, distances and means are whole numbers, so neither
the order of rows nor the number of tasks can change a result.

Vectors that are null, have another number of components than ``dim`` or hold a null or
non-finite one are left out. With fewer vectors than clusters each vector is a centroid; an
empty table gives no rows. Rows with a repeated vec_id are vectors of their own (equal hashes
are ordered by components); a null vec_id comes last among the first centroids. Components of
``LARGEST`` or more would leave the range of a long distance: the query stops with an error
that says so.
"""

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut, prepared

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
#: Below this size of a scaled component, squared distances of up to 128 components fit a long.
LARGEST = 2**27


class Model(NamedTuple):
    """Centroids (k, dim); per centroid the others by (squared distance, number), and the
    smallest squared distance from a vector at which each of them must still be looked at."""

    centroids: np.ndarray
    order: np.ndarray
    least: np.ndarray


def model_of(centroids: np.ndarray) -> Model:
    k = len(centroids)
    apart = np.square(centroids[:, None] - centroids[None]).sum(2)
    # itself first, so that every list has k entries; the search has seen it by then
    apart[np.arange(k), np.arange(k)] = -1
    order = np.argsort(apart, axis=1, kind="stable")
    return Model(centroids, order, (np.take_along_axis(apart, order, 1) + 3) // 4)


def search(model: Model, vectors: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance, centroids looked at) of each vector."""
    n, k = len(vectors), len(model.centroids)
    best = np.full(n, start)
    near = np.square(vectors - model.centroids[start]).sum(1)
    looked = np.ones(n, np.int64)
    seen = np.zeros((n, k), bool)
    seen[:, start] = True
    live = np.arange(n)
    while len(live):
        # the first entry of the present list that this vector has not met
        unmet = ~np.take_along_axis(seen[live], model.order[best[live]], 1)
        at = unmet.argmax(1)
        some = unmet[np.arange(len(live)), at]
        some &= model.least[best[live], at] <= near[live]
        live, at = live[some], at[some]
        other = model.order[best[live], at]
        seen[live, other] = True
        looked[live] += 1
        far = np.square(vectors[live] - model.centroids[other]).sum(1)
        nearer = (far < near[live]) | ((far == near[live]) & (other < best[live]))
        moved = live[nearer]
        best[moved], near[moved] = other[nearer], far[nearer]
    return best, near, looked


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def whole_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, q): the vectors that take part, as whole numbers."""
    x = F.col("embedding")
    fit = F.size(x) == dim
    fit &= F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    kept = vectors.filter(F.coalesce(fit, F.lit(False)))
    small = F.forall("q", lambda v: F.abs(v) < LARGEST)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    error = F.raise_error(F.lit(f"a component is not below {LARGEST // SCALE} in size, so squared distances may leave the range of a long"))
    return kept.select("vec_id", whole.alias("q")).withColumn("q", F.when(small, F.col("q")).otherwise(error))


def _first(rows: DataFrame, clusters: int) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    found = rows.orderBy(digest.asc_nulls_last(), "q").limit(clusters).select("q").collect()
    return np.array([r.q for r in found], np.int64)


def _moved(rows: DataFrame, model: Model, dim: int) -> np.ndarray:
    """The centroids after a round: each task folds its vectors to one row a centroid."""
    k = len(model.centroids)
    names = ["cluster", "n", *[f"s{i}" for i in range(dim)]]

    def fold(batches):
        sums, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("q"), dim)
            best, _, _ = search(model, vectors)
            by = np.argsort(best, kind="stable")
            here, starts = np.unique(best[by], return_index=True)
            if len(here):
                sums[here] += np.add.reduceat(vectors[by], starts, axis=0)
                count += np.bincount(best, minlength=k)
        met = np.flatnonzero(count)
        columns = [pa.array(met), pa.array(count[met]), *[pa.array(sums[met, i]) for i in range(dim)]]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    folded = rows.select("q").mapInArrow(fold, ", ".join(f"{n} bigint" for n in names))
    totals = folded.groupBy("cluster").agg(*[F.sum(n).alias(n) for n in names[1:]])
    centroids = model.centroids.copy()
    for r in totals.collect():
        centroids[r.cluster] = [total // r.n for total in r[2:]]
    return centroids


def fitted(rows: DataFrame, dim: int = DIM, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Model | None:
    """Lloyd rounds over whole vectors (vec_id, q); None where there are none."""
    centroids = _first(rows, clusters)
    if not len(centroids):
        return None
    for _ in range(rounds):
        centroids = _moved(rows, model_of(centroids), dim)
    return model_of(centroids)


def assigned(rows: DataFrame, model: Model, dim: int = DIM) -> DataFrame:
    """(vec_id, cluster, distance, looked) of whole vectors."""

    def run(batches):
        for batch in batches:
            best, near, looked = search(model, _matrix(batch.column("q"), dim))
            arrays = [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(near), pa.array(looked)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance", "looked"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "q").mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint, looked bigint")


def clustered(vectors: DataFrame, dim: int = DIM, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256."""
    spark = prepared(vectors.sparkSession)
    rows = cut(whole_vectors(vectors, dim))
    model = fitted(rows, dim, clusters, rounds)
    if model is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        sums = "cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, {sums}")
    out = cut(assigned(rows, model, dim).drop("looked"))
    sums = {r.cluster: r.total for r in out.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in model.centroids.tolist()]
    total = sum(sums.values())
    known = [(c, s, total, digests[c]) for c, s in sorted(sums.items())]
    of_cluster = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return out.join(F.broadcast(of_cluster), "cluster").select(*out.columns, *of_cluster.columns[1:])


def _oracle() -> str:
    """The same clustering by comparing every vector with every centroid."""
    digits = f"list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT))"
    fit = "len(embedding) = {d} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {d}".format(d=DIM)
    steps = [
        f"kept AS (SELECT row_number() OVER () AS place, vec_id, {digits} AS q FROM embeddings WHERE {fit})",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), q) - 1 AS cluster, q
            FROM kept QUALIFY cluster < {CLUSTERS})""",
    ]
    square = "list_sum(list_transform(list_zip(k.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        steps.append(
            f"""a{r} AS (SELECT place, vec_id, any_value(q) AS q, min({{'d': d, 'c': cluster}}) AS m FROM (
                SELECT k.place, k.vec_id, k.q, c.cluster, CAST({square} AS BIGINT) AS d FROM kept k CROSS JOIN c{r} c) GROUP BY place, vec_id)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""m{r} AS (SELECT cluster, list(mean ORDER BY i) AS q FROM (
                    SELECT m.c AS cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n, (s - ((s % n + n) % n)) // n AS mean FROM (
                        SELECT m, unnest(q) AS x, unnest(range({DIM})) AS i FROM a{r}) GROUP BY m.c, i) GROUP BY cluster)"""
            )
            steps.append(f"c{r + 1} AS (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m USING (cluster))")
    last = ROUNDS
    return f"""WITH {", ".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in steps)}
        SELECT a.vec_id, CAST(a.m.c AS INTEGER) AS cluster, a.m.d AS distance,
            CAST(sum(a.m.d) OVER (PARTITION BY a.m.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.m.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.q, ',')) AS centroid_sha256
        FROM a{last} a JOIN c{last} c ON a.m.c = c.cluster"""


ORACLE_SQL = _oracle()
