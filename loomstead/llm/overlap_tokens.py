"""Token counts of documents of any length by overlap resynchronisation.

Documents up to ``CHUNK`` characters are encoded in one go. Longer ones are cut into chunks
that overlap; the chunks are dealt out, and each is encoded on its own with offsets. Where a
chunk begins in the middle of a document its first tokens may differ from the true ones, and
so may the last ones before its end. The splitting pattern of the tokenizer looks at nothing
before its position and at most ``AHEAD`` characters beyond a match, so once both chunks of an
overlap begin a pre-token at the same character, ``AHEAD`` or more before the first chunk's
end, they agree from there on. That is a proven common boundary, and chunks are spliced there.

An overlap without such a boundary (one long run of letters, say) fails; the documents that
hold one are encoded again with overlaps and chunks ``WIDER`` times as long, until all align. A
chunk that reaches the document's end needs no boundary, so the widening ends.

A null text is empty. An empty document has no tokens. Rows are counted one by one, so
repeated ids give repeated rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut
from loomstead.llm.piece_cache import Pieces, counter

CHUNK = 32_768
OVERLAP = 512
WIDER = 8
#: Characters a match may depend on beyond its end: special strings are the longest.
AHEAD = 32
MOST_TOKENS = 1024

SEAMS = "_at bigint, seam bigint, side int, n bigint, bounds array<bigint>, tokens array<bigint>"


def boundaries(pieces: Pieces, text: str, start: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters at which a pre-token begins (in the document), the tokens before each, and
    the number of tokens."""
    encoded = pieces.tokenizer.encode(text, add_special_tokens=False)
    # An offset leaves out a token's leading space, so the end of the token before is taken.
    words, ends = encoded.word_ids, [e for _, e in encoded.offsets]
    at, before = [], []
    for k in range(1, len(words)):
        if words[k] is None or words[k] != words[k - 1]:
            at.append(start + ends[k - 1])
            before.append(k)
    return np.array(at, np.int64), np.array(before, np.int64), len(words)


def chunk_rows(at: int, text: str, chunk: int, overlap: int):
    """(_at, number, start, whether it is the last, text) of each chunk of a document."""
    step = chunk - overlap
    for number, start in enumerate(range(0, len(text), step)):
        last = start + chunk >= len(text)
        yield at, number, start, last, text[start : start + chunk]
        if last:
            return


def _chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    schema = "_at bigint, number bigint, start bigint, last boolean, part string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for at, text in zip(batch.column("_at").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows = list(chunk_rows(at, text or "", chunk, overlap))
                for k in range(0, len(rows), 32):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + 32], strict=True)], names=names)

    return docs.select("_at", "text").mapInArrow(run, schema)


def _encoded(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Two rows a chunk: its boundaries within the overlap at either end. The first chunk's
    head and the last one's tail carry what no seam accounts for."""

    def run(frames):
        pieces = counter(path)
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                at, before, n = boundaries(pieces, r.part, r.start)
                end = r.start + len(r.part)
                if not r.last:  # the right side of this seam begins at end - overlap
                    near = (at >= end - overlap) & (at <= end - AHEAD)
                    rows.append((r._1, r.number, 0, n, at[near], before[near]))
                if r.number:
                    near = at <= r.start + overlap - AHEAD
                    rows.append((r._1, r.number - 1, 1, n, at[near], before[near]))
                if r.last:
                    rows.append((r._1, -1, 2, n, np.zeros(0, np.int64), np.zeros(0, np.int64)))
            yield pd.DataFrame(rows, columns=["_at", "seam", "side", "n", "bounds", "tokens"])

    return chunks.withColumnRenamed("_at", "_1").select("_1", "number", "start", "last", "part").mapInPandas(run, SEAMS)


def _spliced(seams: DataFrame) -> DataFrame:
    """(_at, n, failed) for each document: the tokens of its last chunk, and at each seam
    those of the left chunk before the boundary less those of the right chunk."""
    sides = {
        side: F.first(F.when(F.col("side") == side, F.struct("bounds", "tokens")), ignorenulls=True) for side in (0, 1)
    }
    own = seams.filter("side < 2").groupBy("_at", "seam").agg(sides[0].alias("l"), sides[1].alias("r"))
    own = own.withColumn("meet", F.array_min(F.array_intersect("l.bounds", "r.bounds")))
    left = F.expr("element_at(l.tokens, CAST(array_position(l.bounds, meet) AS INT))")
    right = F.expr("element_at(r.tokens, CAST(array_position(r.bounds, meet) AS INT))")
    own = own.select("_at", F.when(F.col("meet").isNotNull(), left - right).alias("n"), F.col("meet").isNull().alias("failed"))
    last = seams.filter("side = 2").select("_at", "n", F.lit(False).alias("failed"))
    return own.unionByName(last).groupBy("_at").agg(F.sum("n").alias("n"), F.max("failed").alias("failed"))


def long_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(_at, n) for documents (_at, text) of any length, all of them by chunks."""
    spark = docs.sparkSession
    done, todo = None, docs
    while True:
        chunks = _chunks(todo, chunk, overlap)
        dealt = chunks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_at", "number")
        found = cut(_spliced(_encoded(dealt, path, chunk, overlap)))
        good = found.filter("NOT failed").select("_at", "n")
        done = good if done is None else done.unionByName(good)
        failed = found.filter("failed")
        if failed.isEmpty():
            return done
        overlap *= WIDER
        chunk = max(chunk, 4 * overlap)
        todo = docs.join(failed.select("_at"), "_at", "left_semi")


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, most: int = MOST_TOKENS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    long = F.coalesce(F.length("text") > chunk, F.lit(False))

    def short(batches):
        pieces = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = [sum(x) for x in pieces.each(texts)]
            size = [len(t.encode()) for t in texts]
            arrays = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_tokens"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    counted = rows.filter(~long).mapInArrow(short, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    huge = cut(rows.filter(long).withColumn("_at", F.monotonically_increasing_id()))
    by_chunk = huge.join(long_counts(huge, path, chunk, overlap), "_at").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.col("n").alias("n_tokens")
    )
    return counted.unionByName(by_chunk).withColumn("over_limit", F.col("n_tokens") > most)
