"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node. A node's vector gets one more component, so that all have the same
length and the nearest are those with the largest inner product. That component is never
stored: distances are computed in double precision from differences that keep their digits
however much longer than others some vectors are. Vectors travel in single precision, divided by
the longest (lengths may differ by a factor of 10**30), and results are scored with the original
vectors in double precision.

Start: ``TABLES`` times, nodes are bucketed by signs of random projections (large buckets are
cut), and each bucket gives its nodes their nearest within it. NN-descent: a node's neighbours
and the nodes it is a neighbour of are introduced to each other; who finds somebody nearer
keeps the ``DEGREE`` nearest. Rounds go on until less than ``SETTLED`` of the entries of all
lists change in one. Nodes are dealt to blocks; a block fetches each vector it needs
once, compares its nodes' neighbours with each other and sends on what is nearer than anything
the receiver has. Search: a query starts from its own place in the graph and from ``ENTRIES``
nodes of each power of two of lengths (few long ones are near nobody), and again and again
expands the nearest nodes it has not expanded, until the ``BEAM`` nearest all are.

All rows are indexed, every node takes part in every round. Lists per node are bounded by the
degree (a graph's feature); a hub's many back links are ranked in a window that Spark limits
before it shuffles. Recall against brute force is measured in the tests and the README.

Null vectors, vectors of zeros, with null or non-finite components or of another length than
most rows' take no part, nor do rows without vec_id. Rows with equal vectors are all found; ties
go to the smaller vec_id. Rows that repeat a query's vec_id are its own. Fewer than ``TOP``
candidates are all returned; an empty table gives none.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstead.llm.common import cut
from loomstead.session import join_per_key

TOP = 20
DEGREE = 32
TABLES, LEAF = 4, 1600
SETTLED = 0.001
BLOCK = 4096
QUERY_BLOCK = 256
#: So many vectors a block may fetch all of; then this many blocks are enough.
FETCHED, PARTS = 1 << 17, 4
BEAM, STEP = 256, 64
FINAL = 64
ENTRIES = 16
SEED = 10

EDGES = "node bigint, other bigint, sim double"


def _blocks(rows: int, each: int, total: int) -> int:
    """Blocks of about ``each`` rows. While all vectors are few enough to be fetched by one block,
    every block fetches nearly all of them, so their number must not grow with the rows."""
    blocks = max(1, math.ceil(rows / each))
    return min(blocks, PARTS) if total <= FETCHED else blocks


def _valid(rows: DataFrame) -> DataFrame:
    good = "embedding IS NOT NULL AND vec_id IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    return rows.select("vec_id", "embedding").filter(good)


def _binary(vectors: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in vectors.astype(np.float32)], pa.binary())


def _matrix(column) -> np.ndarray:
    parts = list(column)
    # A block whose queries have all ended fetches nothing.
    return np.frombuffer(b"".join(parts), np.float32).reshape(len(parts), -1 if parts else 0).astype(np.float64)


def sized(v: np.ndarray) -> np.ndarray:
    """Vectors, with their squared length and the component that completes it to 1."""
    square = np.minimum(np.square(v).sum(axis=1, keepdims=True), 1)
    return np.hstack([v, square, np.sqrt(1 - square)])


def closeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minus the squared distances of completed vectors. The completing components differ by
    the difference of the squares over their sum, which no long vector can round away."""
    square, other = a[:, -2:-1], b[:, -2]
    apart = (other - square) / np.maximum(a[:, -1:] + b[:, -1], 1e-150)
    return 2 * (a[:, :-2] @ b[:, :-2].T) - square - other - np.square(apart)


def indexed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, node) and nodes (node, embedding, vec) of the vectors that take part."""
    good = _valid(rows)
    sizes = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = sizes[0]["n"] if sizes else 0
    # Zeros of either sign are one value, in the hash too.
    plain = F.expr("transform(embedding, x -> IF(x = 0, CAST(0 AS FLOAT), CAST(x AS FLOAT)))")
    good = good.filter(F.size("embedding") == width).withColumn("node", F.xxhash64(plain))
    members = cut(good.select("vec_id", "node"))
    distinct = cut(good.groupBy("node").agg(F.first("embedding").alias("embedding")))
    square = F.expr("aggregate(embedding, 0D, (a, x) -> a + double(x) * double(x))")
    longest = distinct.agg(F.max(square)).first()[0] or 1.0

    def run(batches):
        for batch in batches:
            v = np.array(batch.column("embedding").to_pylist(), np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("node"), _binary(v / math.sqrt(longest))], names=["node", "vec"])

    vectors = cut(distinct.mapInArrow(run, "node bigint, vec binary"))
    return members, distinct.join(vectors, "node")


def _top(edges: DataFrame, degree: int) -> DataFrame:
    """(node, ids, least): each node's nearest others, nearest first, and how near the last is
    (minus infinity if there is room)."""
    best = edges.repartition("node").groupBy("node", "other").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    best = best.withColumn("_rank", rank).filter(F.col("_rank") <= degree)
    near = best.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("_rank", "other", "sim"))).alias("l"))
    least = F.when(F.size("l") < degree, F.lit(-math.inf)).otherwise(F.element_at("l", -1)["sim"])
    return near.select("node", F.col("l.other").alias("ids"), F.col("l.sim").alias("sims"), least.alias("least"))


def _nearest(sims: np.ndarray, degree: int) -> np.ndarray:
    if sims.shape[1] <= degree:
        return np.argsort(-sims, axis=1, kind="stable")
    part = np.argpartition(-sims, degree - 1, axis=1)[:, :degree]
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(sims, part, 1), axis=1, kind="stable"), 1)


def _first_edges(vectors: DataFrame, total: int, degree: int) -> DataFrame:
    """Edges to the nearest within buckets of equal signs of random projections."""
    bits = max(0, math.ceil(math.log2(max(total, 1) / LEAF)))

    def signs(batches):
        for batch in batches:
            v = _matrix(batch.column("vec").to_pylist())
            rng = np.random.default_rng(SEED)
            keys = np.stack([((v @ rng.standard_normal((v.shape[1], bits)) > 0) @ (1 << np.arange(bits))) * TABLES + t for t in range(TABLES)], axis=1)
            keys = pa.array(list(keys.astype(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("vec"), keys], names=["node", "vec", "keys"])

    dealt = vectors.mapInArrow(signs, "node bigint, vec binary, keys array<bigint>").select("node", "vec", F.explode("keys").alias("key"))
    sizes = dealt.groupBy("key").agg(F.count("*").alias("n"))
    dealt = join_per_key(dealt, sizes, ["key"], "inner")
    part = F.expr(f"pmod(xxhash64(node, key), CAST(ceil(n / {2 * LEAF}) AS INT))").alias("part")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        v, node = sized(_matrix(frame["vec"])), frame["node"].to_numpy()
        out = []
        for a in range(0, len(v), 512):
            s = closeness(v[a : a + 512], v)
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
            k = _nearest(s, min(degree, len(v) - 1))
            out.append(pd.DataFrame({"node": np.repeat(node[a : a + 512], k.shape[1]), "other": node[k].ravel(), "sim": np.take_along_axis(s, k, 1).ravel()}))
        return pd.concat(out)

    return dealt.select("node", "vec", "key", part).groupBy("key", "part").applyInPandas(run, EDGES)


def _lists(graph: DataFrame, degree: int) -> DataFrame:
    """(node, near): a node's neighbours, and the nearest it is a neighbour of."""
    back = graph.select(F.col("node").alias("other"), F.explode(F.arrays_zip("ids", "sims")).alias("e"))
    back = back.select(F.col("e.ids").alias("node"), "other", F.col("e.sims").alias("sim"))
    back = _top(back, degree).select("node", F.col("ids").alias("back"))
    return graph.join(back, "node", "left").select(
        "node", F.array_union("ids", F.coalesce("back", F.expr("CAST(array() AS array<bigint>)"))).alias("near")
    )


def _descended(graph: DataFrame, vectors: DataFrame, blocks: int, degree: int) -> DataFrame:
    """One round of NN-descent."""
    lists = cut(_lists(graph, degree))
    block = F.expr(f"CAST(pmod(xxhash64(node, {SEED}), {blocks}) AS INT)").alias("block")
    wanted = lists.select(block, F.explode("near").alias("node")).distinct()
    known = vectors.join(graph.select("node", "least"), "node")
    empty = F.expr("CAST(array() AS array<bigint>)")
    fetched = wanted.join(known, "node").select("block", "node", "vec", "least", empty.alias("near"))
    own = lists.select(block, "node", F.lit(None).cast("binary").alias("vec"), F.lit(0.0).alias("least"), "near")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        near = [x for x in frame["near"] if len(x) > 1]
        frame = frame[frame["vec"].notna()].sort_values("node")
        node, least, v = frame["node"].to_numpy(), frame["least"].to_numpy(), sized(_matrix(frame["vec"]))
        rows: list[np.ndarray] = []
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

        def fold(best, rows):
            a, b, s = (np.concatenate([x, *[r[k] for r in rows]]) for k, x in enumerate(best))
            _, one = np.unique(a * len(node) + b, return_index=True)
            a, b, s = a[one], b[one], s[one]
            o = np.lexsort((b, -s, a))
            a, b, s = a[o], b[o], s[o]
            rank = np.arange(len(a)) - np.searchsorted(a, a, "left")
            return a[rank < degree], b[rank < degree], s[rank < degree]

        for ids in near:
            at = np.searchsorted(node, ids)
            w = v[at]
            s = closeness(w, w)
            np.fill_diagonal(s, -np.inf)
            i, j = np.nonzero(s > least[at][:, None])
            rows.append((at[i], at[j], s[i, j]))
            if len(rows) == 512:
                best, rows = fold(best, rows), []
        a, b, s = fold(best, rows)
        return pd.DataFrame({"node": node[a], "other": node[b], "sim": s})

    found = own.unionByName(fetched).groupBy("block").applyInPandas(run, EDGES)
    old = graph.select("node", F.explode(F.arrays_zip("ids", "sims")).alias("e")).select("node", F.col("e.ids").alias("other"), F.col("e.sims").alias("sim"))
    return cut(_top(old.unionByName(found), degree))


def _changed(before: DataFrame, after: DataFrame) -> float:
    """The share of the list entries that were not in the lists before."""
    both = after.join(before.select("node", F.col("ids").alias("old")), "node", "left")
    new = F.size(F.array_except("ids", F.coalesce("old", F.expr("CAST(array() AS array<bigint>)"))))
    found = both.agg(F.sum(new), F.sum(F.size("ids"))).first()
    return (found[0] or 0) / max(found[1] or 0, 1)


def neighbour_graph(vectors: DataFrame, total: int, degree: int = DEGREE, settled: float = SETTLED) -> DataFrame:
    """(node, near): the graph by NN-descent over (node, vec), back links included. Lists only
    get nearer, so the rounds end."""
    graph = cut(_top(_first_edges(vectors, total, degree), degree))
    while True:
        before, graph = graph, _descended(graph, vectors, _blocks(total, BLOCK, total), degree)
        if _changed(before, graph) <= settled:
            break
    return cut(_lists(graph, degree))


def _entries(vectors: DataFrame) -> list[int]:
    """Up to ``ENTRIES`` nodes of each power of two of lengths."""

    def run(batches):
        for batch in batches:
            square = np.square(_matrix(batch.column("vec").to_pylist())).sum(axis=1)
            power = np.frexp(np.maximum(square, 1e-300))[1] // 2
            yield pa.RecordBatch.from_arrays([pa.array(power.astype(np.int32)), batch.column("node")], names=["power", "node"])

    some = vectors.mapInArrow(run, "power int, node bigint").groupBy("power", F.expr(f"pmod(node, {ENTRIES})").alias("slot"))
    return sorted(r["node"] for r in some.agg(F.min("node").alias("node")).collect())


def _searched(queries: DataFrame, vectors: DataFrame, lists: DataFrame, blocks: int) -> DataFrame:
    """(node, found): for each query node the ids of the ``FINAL`` nearest nodes found."""
    block = F.expr(f"CAST(pmod(xxhash64(node, {SEED}), {blocks}) AS INT)").alias("block")
    kind = "block int, node bigint, vec binary, ids array<bigint>, sims array<double>, done array<boolean>"
    none = {"ids": "array<bigint>", "sims": "array<double>", "done": "array<boolean>"}
    empty = [F.expr(f"CAST(array() AS {t})").alias(n) for n, t in none.items()]
    state = cut(queries.join(vectors, "node").select(block, "node", "vec", *empty))
    starts = _entries(vectors)
    frontier = state.select("block", F.explode(F.array(F.col("node"), *map(F.lit, starts))).alias("node"))
    while True:
        # The lists of the nodes to expand, and the vectors of all nodes on them, once a block.
        opened = cut(frontier.distinct().join(lists, "node").select("block", "node", "near"))
        wanted = opened.select("block", F.explode("near").alias("node")).unionByName(opened.select("block", "node")).distinct()
        fetched = wanted.join(vectors, "node").join(opened, ["block", "node"], "left").select("block", "node", "vec", "near")

        def run(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("node")
            node, v, near = rows["node"].to_numpy(), _matrix(rows["vec"]), rows["near"].to_numpy()
            out = []
            for r in own.itertuples():
                q = np.frombuffer(r.vec, np.float32).astype(np.float64)
                ids, sims, done = np.array(r.ids, np.int64), np.array(r.sims, np.float64), np.array(r.done, bool)
                todo = np.flatnonzero(~done)[:STEP] if len(ids) else np.zeros(0, int)
                opened_now = ids[todo] if len(ids) else np.unique(np.array([r.node, *starts], np.int64))
                done[todo] = True
                if len(opened_now) and len(node):
                    at = np.searchsorted(node, opened_now)
                    new = np.unique(np.concatenate([near[k] for k in at if near[k] is not None] + [opened_now if not len(ids) else ids[:0]]))
                    new = new[~np.isin(new, ids)].astype(np.int64)
                    s = v[np.searchsorted(node, new)] @ q
                    ids, sims = np.concatenate([ids, new]), np.concatenate([sims, s])
                    done = np.concatenate([done, np.isin(new, opened_now)])
                    o = np.lexsort((ids, -sims))[:BEAM]
                    ids, sims, done = ids[o], sims[o], done[o]
                out.append((r.block, r.node, r.vec, ids, sims, done))
            return pd.DataFrame(out, columns=["block", "node", "vec", "ids", "sims", "done"])

        state = cut(state.groupBy("block").cogroup(fetched.groupBy("block")).applyInPandas(run, kind))
        # The next to expand: the first STEP of the beam that are not done.
        step = F.expr(f"slice(filter(ids, (x, i) -> NOT done[i]), 1, {STEP})")
        frontier = state.select("block", F.explode(step).alias("node"))
        if frontier.isEmpty():
            return state.select("node", F.slice("ids", 1, FINAL).alias("found"))


def nearest(rows: DataFrame, is_query: str, top: int = TOP, degree: int = DEGREE, settled: float = SETTLED) -> DataFrame:
    """The ``top`` nearest rows found for each row that ``is_query`` (SQL over vec_id) names:
    query_id, rank, vec_id, score."""
    members, nodes = indexed(rows)
    vectors = cut(nodes.select("node", "vec"))
    total = vectors.count()
    asked = members.filter(is_query).distinct()
    asking = cut(asked.select("node").distinct())
    found = cut(_searched(asking, vectors, neighbour_graph(vectors, total, degree, settled), _blocks(asking.count(), QUERY_BLOCK, total)))
    # Exact scores of the nodes found, of which enough to hold the nearest rows are kept.
    plain = nodes.select("node", "embedding")
    pairs = found.select("node", F.explode("found").alias("other"))
    pairs = pairs.join(plain, "node").join(plain.select(F.col("node").alias("other"), F.col("embedding").alias("theirs")), "other")

    def scores(batches):
        for batch in batches:
            a, b = (np.array(batch.column(n).to_pylist(), np.float64).reshape(batch.num_rows, -1) for n in ("embedding", "theirs"))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("other"), pa.array((a * b).sum(axis=1))], names=["node", "other", "score"])

    scored = pairs.mapInArrow(scores, "node bigint, other bigint, score double")
    order = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "other"))
    scored = cut(scored.withColumn("_r", order).filter(F.col("_r") <= FINAL).drop("_r"))
    # Of each node's rows the smallest ids suffice: one more than asked for, as one may be the query.
    place = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    few = cut(members.withColumn("_r", place).filter(F.col("_r") <= top + 1).select(F.col("node").alias("other"), F.col("vec_id").alias("their_id")))
    whole = scored.join(few, "other")
    order = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "their_id"))
    best = cut(whole.withColumn("_r", order).filter(F.col("_r") <= top + 1).select("node", "their_id", "score"))
    out = asked.join(best, "node").filter("their_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("score"), "their_id"))
    return out.select(F.col("vec_id").alias("query_id"), rank.alias("rank"), F.col("their_id").alias("vec_id"), "score").filter(F.col("rank") <= top)
