"""SimHash near-duplicates with BK-trees.

Fingerprints are linked where at most ``RADIUS`` of their 64 bits differ. Cut into
``RADIUS + 2`` blocks of bits, two such fingerprints agree on at least two blocks, so every
link lies within a shard of fingerprints with equal bits in a pair of blocks. Each shard gets
a BK-tree, whose children are keyed by their Hamming distance from the parent, and a search
follows only the edges within the radius. A tree travels to the task of its own shard only:
trees for all fingerprints would grow with the corpus and may not be broadcast. A shard above
``SHARD`` fingerprints is cut into parts, and the tree of each part is searched with every part.

Equal fingerprints are one node, so copies are never paired. Each shard hands on a spanning
forest of its links, and components join the forests: no link is lost, none is repeated.

Nulls: a null text is empty, with fingerprint zero, linked like any other. A null doc_id is
ignored as a component's smallest id; a component without any id has a null component_id.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut, texts_of, tidy, with_columns
from loomstead.llm.groups import Sets, arranged, components, crowded, runs
from loomstead.session import join_per_key

RADIUS = 3
WORDS = 3
SEED = 42
SHARD = 2048
WIDTHS = (13, 13, 13, 13, 12)


def fingerprint(text: bytes) -> int:
    """64-bit SimHash over shingles of three words, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(WORDS)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batch: pa.RecordBatch) -> dict:
    return {"_fp": np.array([fingerprint(t) for t in texts_of(batch)], np.int64)}


class BKTree:
    """Numbers by Hamming distance: the child under edge d differs from its parent in d bits."""

    def __init__(self):
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        new = len(self.values)
        self.values.append(value)
        self.edges.append({})
        at = 0
        while at != new:
            at = self.edges[at].setdefault((value ^ self.values[at]).bit_count(), new)
        return new

    def near(self, value: int, radius: int):
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            apart = (value ^ self.values[at]).bit_count()
            if apart <= radius:
                yield at
            edges = self.edges[at]
            if len(edges) <= 2 * radius + 1:
                todo += [node for d, node in edges.items() if -radius <= d - apart <= radius]
            else:
                todo += [edges[d] for d in range(apart - radius, apart + radius + 1) if d in edges]


def _linked(batches):
    """A spanning forest of each shard's links, found by searching its BK-tree."""
    left, right = [], []
    for run in runs(batches):
        signed = run["fp"]
        values = [int(x) for x in signed.astype(np.uint64)]
        if len(values) < 2:
            continue
        lo, hi = int(run["lo"][0]), int(run["hi"][0])
        tree, sets, nodes = BKTree(), Sets(len(values)), []
        for k, value in enumerate(values):
            own = lo == hi
            if own or run["part"][k] == hi:
                for found in tree.near(value, RADIUS):
                    if sets.join(nodes[found], k):
                        left.append(int(signed[nodes[found]]))
                        right.append(int(signed[k]))
            if own or run["part"][k] == lo:
                tree.add(value)
                nodes.append(k)
        if len(left) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
            left, right = [], []
    yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _shards(column: str) -> str:
    starts = [sum(WIDTHS[:k]) for k in range(len(WIDTHS))]
    block = [f"(shiftrightunsigned({column}, {s}) & {(1 << w) - 1})" for s, w in zip(starts, WIDTHS, strict=True)]
    pairs = combinations(range(len(WIDTHS)), 2)
    return "array(" + ", ".join(f"(shiftleft({block[a]}, 13) | {block[b]}) * 16 + {k}" for k, (a, b) in enumerate(pairs)) + ")"


def linked_fingerprints(prints: DataFrame) -> DataFrame:
    """(node, root) for the distinct fingerprints ``fp`` that have any link."""
    keyed = prints.select("fp", F.explode(F.expr(_shards("fp"))).alias("key"))
    return components(arranged(crowded(keyed), "fp", SHARD).mapInArrow(tidy(_linked), "a bigint, b bigint"))


def _classes(prints: DataFrame) -> DataFrame:
    """(fp, component) for every distinct fingerprint, with its smallest ``first``."""
    roots = cut(linked_fingerprints(prints))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left")
    rooted = cut(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")))
    best = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return join_per_key(rooted, best, ["root"], "inner").select("fp", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    slim = with_columns(docs, "_fp bigint", _fingerprints, "doc_id", "text")
    slim = cut(slim.select("doc_id", F.col("_fp").alias("fp")))
    prints = cut(slim.groupBy("fp").agg(F.min("doc_id").alias("first")))
    out = join_per_key(slim, _classes(prints), ["fp"], "inner")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each component (one row of it, were the id
    repeated; a null id comes last), with all of its columns."""
    whole = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    whole = cut(with_columns(whole, "_fp bigint", _fingerprints).withColumn("_at", F.monotonically_increasing_id()))
    order = F.struct(F.col("_row.doc_id").isNull().alias("none"), F.col("_row.doc_id").alias("doc_id"), F.col("_at").alias("at"))
    slim = whole.select(F.col("_fp").alias("fp"), order.alias("first"))
    prints = cut(slim.groupBy("fp").agg(F.min("first").alias("first")))
    kept = join_per_key(slim, _classes(prints), ["fp"], "inner")
    gone = cut(kept.filter("first.at <> component.at").select(F.col("first.at").alias("_at")))
    return whole.join(gone, "_at", "left_anti").select("_row.*")
