"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source are permuted by a hash and cut into ``BLOCKS`` blocks, the ranges of
the hash. A target of r times the source's size takes every block floor(r) times, and further
blocks in permuted order up to the target; the block on the border is cut by the next bits of
the hash, and again, until few documents are undecided; what is then still missing is filled by ``FILLS``
single documents, each the largest that fits.

The takings (block copies) are dealt to output shards by a splitting tree: the root holds each
source's exact quota of block copies; a node gives its left half a multivariate-hypergeometric
draw of its quotas, in proportion to the shards below, and the rest goes right. So each shard's
quotas add up exactly, and shards differ by chance as a shuffled deck would. The draws are
seeded by the node, so reruns agree. Sources are gathered in a fixed number of buckets; the
buckets' quotas are drawn first, and each bucket's own tree divides what its shards got. A shard takes the next blocks of each source's permuted
sequence; within the shard, documents are ordered by a hash.

Only sizes are aggregated: words per (source, block), at most ``BLOCKS`` rows a source. Texts
are never moved by the plan.

Nulls: a null text has size 0, null sources are one source, last in order. Documents of size 0
are taken like any other of their block. A null doc_id counts as id null. Rows with one id
share a block. An empty table gives no rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstead.llm.common import cut, null_safe_key, with_columns, word_counts

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
#: Blocks of a source, as bits of the hash; the one on the border is cut by so many more bits.
BLOCK_BITS = 8
CUT_BITS, CUTS = 8, 4
FILLS = 6
SHARDS = 64
BUCKETS = 512
SEED = 20


def _sizes(batch: pa.RecordBatch) -> dict:
    return {"_size": word_counts(batch)}


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_place", F.expr(f"shiftrightunsigned(xxhash64(doc_id, {SEED}), 1)")).withColumn(
        "_key", null_safe_key("source")
    )


def targets(slim: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source (_key): its size and target. The targets share ``share`` of all sizes
    by weight; one that would pass ``most`` times its source's size stops there, and the excess
    is shared by weight among the others, until none is above."""
    totals = cut(slim.groupBy("_key", "source").agg(F.sum("_size").alias("source_size")))
    # Ranks by code point, nulls last, without bringing the sources into one task.
    order = totals.select("_key", "source").orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    ranks = totals.sparkSession.createDataFrame(order.map(lambda r: (r[0][0], r[1])), "_key string, rank bigint")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = cut(totals.join(ranks, "_key").select("_key", "source_size", weight.alias("weight")))
    whole = share * float(rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    top, level = F.lit(most) * F.col("source_size"), 0.0
    while True:
        over = top <= F.col("weight") * F.lit(level)
        fixed, free = rows.agg(
            F.coalesce(F.sum(F.when(over, top)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))
        ).first()
        new = (whole - fixed) / free if free else level
        if new <= level:
            break
        level = new
    return rows.select("_key", "source_size", F.least(top, F.col("weight") * F.lit(level)).alias("target"))


def _borders(slim: DataFrame, goals: DataFrame) -> DataFrame:
    """Add to each source: ``every``, how often each document is taken; ``until``, the places
    below which it is taken once more, found digit by digit from sums of sizes; and ``extra``,
    the places of single documents that fill up the target."""
    every = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    state = goals.withColumn("every", every).withColumn("left", F.col("target") - F.col("every") * F.col("source_size"))
    state = cut(state.withColumn("until", F.lit(0).cast("bigint")).withColumn("extra", F.expr("CAST(array() AS array<bigint>)")))
    shift = 63
    for bits in (BLOCK_BITS, *[CUT_BITS] * CUTS):
        high, shift = shift, shift - bits
        inside = slim.join(state, "_key").filter(F.expr(f"shiftright(_place, {high}) = shiftright(until, {high})"))
        sums = inside.groupBy("_key", "left", F.expr(f"shiftright(_place, {shift})").alias("digit")).agg(F.sum("_size").alias("words"))
        upto = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("_key").orderBy("digit")))
        fits = F.col("upto") <= F.col("left")
        border = upto.groupBy("_key").agg(
            F.max(F.when(fits, F.col("upto"))).alias("words"), F.min(F.when(~fits, F.col("digit"))).alias("next")
        )
        after = F.expr(f"coalesce(shiftleft(next, {shift}), until)")
        state = cut(state.join(border, "_key", "left").select(
            "_key", "source_size", "target", "every", (F.col("left") - F.coalesce("words", F.lit(0))).alias("left"),
            after.alias("until"), "extra",
        ))
    for _ in range(FILLS):
        free = slim.join(state, "_key").filter("_place >= until AND _size > 0 AND _size <= left AND NOT array_contains(extra, _place)")
        best = free.groupBy("_key").agg(F.max("_size").alias("words"), F.max_by("_place", F.struct("_size", "_place")).alias("place"))
        state = cut(state.join(best, "_key", "left").select(
            "_key", "source_size", "target", "every", (F.col("left") - F.coalesce("words", F.lit(0))).alias("left"), "until",
            F.when(F.col("place").isNull(), F.col("extra")).otherwise(F.array_append("extra", F.col("place"))).alias("extra"),
        ))
    return state


def split_tree(quotas: np.ndarray, shards: np.ndarray, seed) -> np.ndarray:
    """Deal each kind's quota (rows) to shards (columns) of the given sizes, which add up to
    the quotas: at each node the left half's share is a multivariate-hypergeometric draw."""
    out = np.zeros((len(quotas), len(shards)), np.int64)

    def node(counts: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            out[:, first] = counts
            return
        middle = (first + last) // 2
        rng = np.random.default_rng([*seed, first, last])
        left = rng.multivariate_hypergeometric(counts, int(shards[first:middle].sum()), method="marginals")
        node(left, first, middle)
        node(counts - left, middle, last)

    if len(quotas) and len(shards):
        node(np.asarray(quotas, np.int64), 0, len(shards))
    return out


def _dealt(state: DataFrame, shards: int) -> DataFrame:
    """Add ``upto``: for each source and shard, the block copies of the source that have been
    dealt when the shard has its own. Copy c of block b is number c * blocks + b."""
    blocks = 1 << BLOCK_BITS
    quota = F.expr(f"every * {blocks} + shiftright(until, {63 - BLOCK_BITS}) + IF(until & {(1 << 63 - BLOCK_BITS) - 1}L = 0, 0, 1) + size(extra)")
    rows = cut(state.withColumn("quota", quota).withColumn("bucket", F.expr(f"pmod(xxhash64(_key), {BUCKETS})")))
    totals = sorted((r[0], r[1]) for r in rows.groupBy("bucket").agg(F.sum("quota")).collect())  # at most BUCKETS rows
    every, rest = divmod(sum(n for _, n in totals), shards)
    sizes = np.array([every + (k < rest) for k in range(shards)], np.int64)
    dealt = split_tree(np.array([n for _, n in totals], np.int64), sizes, (SEED,))
    of_bucket = {b: dealt[k] for k, (b, _) in enumerate(totals)}

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_key")
        parts = split_tree(frame["quota"].to_numpy(), of_bucket[key[0]], (SEED, int(key[0])))
        return pd.DataFrame({"_key": frame["_key"].to_numpy(), "upto": list(parts.cumsum(axis=1))})

    upto = rows.select("bucket", "_key", "quota").groupBy("bucket").applyInPandas(run, "_key string, upto array<bigint>")
    return cut(state.join(upto, "_key"))


def mix(slim: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mix of measured rows (source, _key, _size, _place): one row per source, with its
    size and target and what says how often and in which shards a document is taken."""
    return _dealt(_borders(slim, targets(slim)), shards)


def _takings(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """Add to rows how often they are taken, and the shard of each copy."""
    out = rows.join(mixed, "_key")
    copies = F.expr(f"CAST(least({int(MOST)}, every + IF(_place < until OR array_contains(extra, _place), 1, 0)) AS INT)")
    number = f"(c - 1) * {1 << BLOCK_BITS} + shiftright(_place, {63 - BLOCK_BITS})"
    shard = F.expr(f"transform(slice(array(1, 2), 1, copies), c -> CAST(least(size(upto) - 1, size(filter(upto, u -> u <= {number}))) AS INT))")
    return out.withColumn("copies", copies).withColumn("shards", shard)


def takings(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, shards."""
    rows = with_columns(docs, "_size bigint", _sizes, "doc_id", "source", "text").drop("text")
    slim = cut(_placed(rows))
    return _takings(slim, mix(slim)).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("copies") * F.col("_size")).alias("taken"),
        "copies", "shards",
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, dealt to the shards and in
    hashed order within each, with all of its columns."""
    whole = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    slim = cut(_placed(with_columns(whole.select("doc_id", "source", "text"), "_size bigint", _sizes).drop("text")))
    rows = _takings(_placed(whole), mix(slim)).select("_row", "doc_id", F.posexplode("shards").alias("_copy", "_shard"))
    dealt = rows.repartition("_shard").sortWithinPartitions("_shard", F.expr(f"xxhash64(doc_id, _copy, {SEED + 1})"))
    return dealt.select("_row.*")
