"""Groups that share a key, of any size, and the components that links make of them."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut
from loomstead.session import join_per_key


def crowded(keyed: DataFrame) -> DataFrame:
    """Rows whose ``key`` (a long) another row has too, with the key's number of rows as _n.

    Keys are counted after map-side folding. Only the crowded ones are joined back, between
    exchanges of the join's own (so that a hot key can be split), which takes a second join
    column; a few bits of the key serve, as they hardly add to what is moved.
    """
    sizes = keyed.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1")
    some = F.expr("key & 15L").alias("_bits")
    return keyed.select("*", some).join(sizes.select("*", some), ["_bits", "key"]).drop("_bits")


def arranged(rows: DataFrame, spread: str, limit: int) -> DataFrame:
    """Crowded rows, so that every two rows of a key meet in a group of at most about
    ``2 * limit`` rows.

    A key with more rows is cut into parts by a hash of ``spread``; the group (lo, hi) holds
    the rows of both parts. Added columns: lo, hi and the row's own ``part``. The result is
    partitioned and sorted by (key, lo, hi), as ``runs`` wants it.
    """
    names = [c for c in rows.columns if c != "_n"]
    pieces = F.ceil(F.col("_n") / F.lit(limit)).cast("int")
    rows = rows.withColumn("_pieces", pieces).withColumn("part", F.expr(f"CAST(pmod(xxhash64({spread}, 7), _pieces) AS INT)"))
    pairs = F.expr("transform(sequence(0, _pieces - 1), q -> struct(least(part, q) AS lo, greatest(part, q) AS hi))")
    rows = rows.select(*names, "part", F.inline(pairs).alias("lo", "hi"))
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "part", spread)


def runs(batches, names=("key", "lo", "hi")):
    """From the batches of a sorted partition, each group as a dict of arrays."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rest = rows if rest is None else pa.concat_tables([rest, rows])
        columns = {n: rest[n].to_numpy() for n in names}
        new = np.zeros(max(rest.num_rows - 1, 0), bool)
        for c in columns.values():
            new |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        if len(cuts) > 1:
            whole = {n: rest[n].to_numpy() for n in rest.column_names}
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield {n: c[a:b] for n, c in whole.items()}
        rest = rest.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield {n: rest[n].to_numpy() for n in rest.column_names}


class Sets:
    """Disjoint sets of the numbers 0..n-1; the smallest number stands for its set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al. 2014). A node's neighbours
    are folded to their minimum and that one row is joined back, so a node with very many
    neighbours is split over tasks. Every round is written to the shared folder.
    """
    edges = cut(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    seen = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = join_per_key(edges, lowest, ["a"], "inner").select(F.col("_m").alias("a"), "b").distinct()
        large = cut(large)
        lowest = large.groupBy("b").agg(F.min("a").alias("_m"))
        small = join_per_key(large, lowest, ["b"], "inner")
        small = small.select(F.inline(F.expr("array(struct(_m AS a, a AS b), struct(_m AS a, b AS b))")))
        edges = cut(small.filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.expr("CAST(xxhash64(a, b) AS DECIMAL(38, 0))"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle within {most_rounds} rounds")
    roots = edges.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
