"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count is quantised to the number of ``LEVELS`` it reaches (1, 2, 3, 4, 6, 8, 12, ...). An
n-gram of level q is put into a Bloom filter q times, as (n-gram, 1) to (n-gram, q), so rare
n-grams, by far the most, cost one entry. Its count is read back by probing (n-gram, 1),
(n-gram, 2), ... until a probe fails; a false positive can only raise what is read. Single
tokens are kept as exact counts, because the base score needs them.

The probability of a token after its context is smoothed with a Dirichlet prior towards the
next shorter context, from N-grams down to ``(c + 1) / (N + V + 1)`` for the token alone:
``P(w | h) = (c(hw) + K * P(w | h')) / (c(h) + K)``. Levels are read at their lower end and
held below the count of the context and of the shorter n-gram, so nothing is counted twice over.

Counting: each task folds the n-gram hashes of some million tokens at a time and hands them on
packed by segment (the upper bits of the hash), so a hot n-gram is one entry a task. A segment
is folded again and becomes one piece of the filter, sized by the n-grams it really holds. The
number of segments follows the corpus, so a segment has the same size at every scale.

The filter is broadcast while it is below ``BROADCAST`` bytes. It grows with the corpus, so beyond
that documents are dealt to blocks of bounded size; each block sends the distinct n-grams it
needs to their segments and gets the counts back. Both ways read the same filter, and so give the
same scores.

Words are told apart by 64 bits of XXH3 (for V different words about V²/2^65 pairs are
expected to be confused: 10^-6 for five million words). A null or empty text has the end
token alone. A null doc_id counts as the empty id: it is not held out. Rows with a repeated id
are documents of their own. An empty table gives no rows.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut, prepared, texts_of

ORDER = 2
HELD_OUT = "pmod(crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY)), 7) = 2"
#: Weight of the shorter context, in occurrences (of 24 to 1,000 the best on held-out texts for trigrams, near it for bigrams).
PRIOR = 150.0
#: Counts at which an n-gram reaches one more level: about half a power of two apart.
LEVELS = np.array(sorted({math.ceil(2 ** (k / 2)) for k in range(80)}), np.int64)
BITS = 10
PROBES = 5
#: Bytes of text a segment is made for, tokens folded at a time, bytes of text in a block.
SEGMENT_BYTES = 12 << 20
FOLDED = 3_000_000
BLOCK_BYTES = 24 << 20
#: Bytes up to which the counts go to every worker.
BROADCAST = 192 << 20

# No word holds white space, so these two are no words.
START, END = (xxhash.xxh3_64_intdigest(x) for x in (b" start", b" end"))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all their bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text led by the start mark and closed by the
    end token, and the number of tokens of each text (the mark not counted)."""
    digest = xxhash.xxh3_64_intdigest
    parts, sizes = [], []
    for text in texts:
        words = text.lower().split()
        part = np.empty(len(words) + 2, np.uint64)
        part[0], part[-1] = START, END
        part[1:-1] = np.fromiter(map(digest, words), np.uint64, len(words))
        parts.append(part)
        sizes.append(len(words) + 1)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(sizes, np.int64)


def n_grams(tokens: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n from 1: the hash of the n-gram that ends at each place, and whether there is one.

    At the start mark there is none, and none reaches across it; the mark itself counts as a
    token before the first.
    """
    first = tokens == np.uint64(START)
    grams, there, out = tokens, ~first, [(tokens, ~first)]
    for n in range(2, order + 1):
        longer = np.zeros(len(tokens), np.uint64)
        longer[1:] = mixed(grams[:-1] * _ODD + np.uint64(n)) ^ tokens[1:]
        longer = mixed(longer)
        reach = np.zeros(len(tokens), bool)
        reach[1:] = (there[:-1] if n > 2 else True) & ~first[1:]
        out.append((longer, reach))
        grams, there = longer, reach
    return out


# -- counting -----------------------------------------------------------------------------


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each hash; it never falls as the hash grows."""
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _by_segment(hashes: np.ndarray, segments: int):
    """(segment, from, to) of the stretches of sorted hashes."""
    cuts = np.searchsorted(segment_of(hashes, segments), np.arange(segments + 1))
    return [(int(s), cuts[s], cuts[s + 1]) for s in np.flatnonzero(np.diff(cuts))]


def _batches(rows, schema: pa.Schema):
    """Batches of rows that hold large values, some MB each."""
    pending, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pending, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        pending.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > 8 << 20 or len(pending) >= 4096:
            yield batch()
            pending, size = [], 0
    if pending:
        yield batch()


_PACKED = pa.schema([("n", pa.int32()), ("segment", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
_PIECE = pa.schema([("n", pa.int32()), ("segment", pa.int32()), ("entries", pa.int64()), ("total", pa.int64()), ("data", pa.binary())])


def _folded(tokens: np.ndarray, order: int, segments: int):
    for n, (grams, there) in enumerate(n_grams(tokens, order), 1):
        # the start mark is no token, but the context of the first one
        hashes, counts = np.unique(grams if n == 1 else grams[there], return_counts=True)
        for s, a, b in _by_segment(hashes, segments):
            yield n, s, hashes[a:b].tobytes(), counts[a:b].astype("<u4").tobytes()


def _packed(texts: DataFrame, order: int, segments: int) -> DataFrame:
    """n-grams of the texts, folded over some million tokens at a time, packed by segment."""

    def rows(batches):
        parts, size = [], 0
        for batch in batches:
            tokens, _ = token_hashes(texts_of(batch))
            parts.append(tokens)
            size += len(tokens)
            if size >= FOLDED:
                yield from _folded(np.concatenate(parts), order, segments)
                parts, size = [], 0
        if parts:
            yield from _folded(np.concatenate(parts), order, segments)

    return texts.select("text").mapInArrow(lambda b: _batches(rows(b), _PACKED), "n int, segment int, hashes binary, counts binary")


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, "right")


def _pair(grams: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (n-gram, level), from which all its places come."""
    a = mixed(grams ^ np.uint64(level * int(_ODD) % 2**64))
    return a, mixed(a + _ODD)


def _place(a: np.ndarray, b: np.ndarray, probe: int, bits: int) -> np.ndarray:
    return ((a + np.uint64(probe) * b) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)


def filter_piece(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """A Bloom filter in which each n-gram stands once for every level its count reaches."""
    levels = level_of(counts)
    bits = max(64, -(-int(levels.sum()) * BITS // 64) * 64)
    bitmap = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        a, b = _pair(grams[levels >= level], level)
        for k in range(PROBES):
            bitmap[_place(a, b, k, bits).astype(np.int64)] = True
    return np.packbits(bitmap, bitorder="little").tobytes()


def probed(data: bytes, grams: np.ndarray) -> np.ndarray:
    """Counts read back from a piece: the lower end of the level that probing reaches."""
    piece = np.frombuffer(data, np.uint8)
    level = np.zeros(len(grams), np.int64)
    live = np.arange(len(grams))
    for q in range(1, len(LEVELS) + 1):
        a, b = _pair(grams[live], q)
        for k in range(PROBES):
            place = _place(a, b, k, 8 * len(piece))
            hit = (piece[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            live, a, b = live[hit], a[hit], b[hit]
        if not len(live):
            break
        level[live] = q
    return np.where(level > 0, LEVELS[level - 1], 0)


def exact_piece(words: np.ndarray, counts: np.ndarray) -> bytes:
    return len(words).to_bytes(8, "little") + words.astype("<u8").tobytes() + counts.astype("<u4" if counts.max(initial=0) < 2**32 else "<i8").tobytes()


def looked_up(data: bytes, words: np.ndarray) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    known = np.frombuffer(data, "<u8", n, 8)
    counts = np.frombuffer(data, "<u4" if len(data) == 8 + 12 * n else "<i8", n, 8 + 8 * n)
    at = np.minimum(np.searchsorted(known, words), n - 1)
    return np.where(known[at] == words, counts[at].astype(np.int64), 0)


def _piece(packed: pa.Table) -> pa.Table:
    """One segment's n-grams with their counts over all tasks, as a piece of the model."""
    n, segment = packed["n"][0].as_py(), packed["segment"][0].as_py()
    hashes = np.frombuffer(b"".join(packed["hashes"].to_pylist()), "<u8")
    counts = np.frombuffer(b"".join(packed["counts"].to_pylist()), "<u4").astype(np.int64)
    by = np.argsort(hashes)
    grams, starts = np.unique(hashes[by], return_index=True)
    sums = np.add.reduceat(counts[by], starts)
    own = grams != np.uint64(START) if n == 1 else np.ones(len(grams), bool)
    data = (exact_piece if n == 1 else filter_piece)(grams, sums)
    return pa.Table.from_pydict({"n": [n], "segment": [segment], "entries": [int(own.sum())], "total": [int(sums[own].sum())], "data": [data]}, _PIECE)


def trained(texts: DataFrame, segments: int, order: int = ORDER) -> DataFrame:
    """The model as rows (n, segment, entries, total, data): exact counts of single tokens, and
    a piece of the filter for each segment of the longer n-grams."""
    return _packed(texts, order, segments).groupBy("n", "segment").applyInArrow(_piece, "n int, segment int, entries bigint, total bigint, data binary")


# -- scoring ------------------------------------------------------------------------------


def read_piece(n: int, data: bytes, hashes: np.ndarray) -> np.ndarray:
    return (looked_up if n == 1 else probed)(data, hashes)


def read_all(pieces: dict, segments: int, n: int, hashes: np.ndarray) -> np.ndarray:
    """Counts of sorted n-gram hashes from all pieces of the model."""
    counts = np.zeros(len(hashes), np.int64)
    for s, a, b in _by_segment(hashes, segments):
        if (n, s) in pieces:
            counts[a:b] = read_piece(n, pieces[n, s], hashes[a:b])
    return counts


def scores_of(tokens: np.ndarray, order: int, total: int, distinct: int, read):
    """Per place the exact count of the token, log10 of its base probability and of the model's;
    nothing counts at a start mark. ``read`` gives the counts of sorted distinct n-grams."""
    shorter, first = None, tokens == np.uint64(START)
    for n, (grams, there) in enumerate(n_grams(tokens, order), 1):
        asked = np.ones(len(tokens), bool) if n == 1 else there
        values, back = np.unique(grams[asked], return_inverse=True)
        counts = np.zeros(len(tokens), np.int64)
        counts[asked] = read(n, values)[back]
        if n == 1:
            known, p = counts, (counts + 1) / (total + distinct + 1)
            base = p
        else:
            context = np.zeros(len(tokens), np.int64)
            context[1:] = shorter[:-1]
            counts = np.minimum(counts, np.minimum(context, shorter))
            p = np.where(there, (counts + PRIOR * p) / (context + PRIOR), p)
        shorter = counts
    return np.where(first, 0, known), np.where(first, 0, np.log10(base)), np.where(first, 0, np.log10(p))


_SCORED = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
_SCORED_DDL = "n_tokens bigint, n_known bigint, base_score double, score double"


def _document_scores(texts: list[bytes], order: int, total: int, distinct: int, read) -> list[pa.Array]:
    tokens, sizes = token_hashes(texts)
    if not len(sizes):
        return [pa.array([], t) for _, t in _SCORED]
    known, base, score = scores_of(tokens, order, total, distinct, read)
    starts = np.cumsum(sizes + 1) - sizes - 1
    sums = [np.add.reduceat(x, starts) for x in ((known > 0).astype(np.int64), base, score)]
    return [pa.array(x, t) for x, (_, t) in zip([sizes, *sums], _SCORED, strict=True)]


def _by_broadcast(rows: DataFrame, model: DataFrame, segments: int, order: int, total: int, distinct: int) -> DataFrame:
    pieces = rows.sparkSession.sparkContext.broadcast({(r.n, r.segment): bytes(r.data) for r in model.select("n", "segment", "data").toLocalIterator()})
    own = [c for c in rows.columns if c != "text"]

    def run(batches):
        def read(n, hashes):
            return read_all(pieces.value, segments, n, hashes)

        for batch in batches:
            found = _document_scores(texts_of(batch), order, total, distinct, read)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], *found], names=[*own, *[c for c, _ in _SCORED]])

    return rows.mapInArrow(run, f"{_ddl(rows, own)}, {_SCORED_DDL}")


def _ddl(rows: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)


def _by_blocks(rows: DataFrame, model: DataFrame, segments: int, order: int, total: int, distinct: int, blocks: int) -> DataFrame:
    """The same scores where the model is too large to send: distinct n-grams of a block of
    documents go to their segments, and the counts come back to the block."""
    rows = cut(rows.withColumn("_at", F.monotonically_increasing_id())).withColumn("block", F.expr(f"CAST(pmod(xxhash64(_at), {blocks}) AS INT)"))
    own = [c for c in rows.columns if c not in ("text", "_at", "block")]
    asked_schema = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("segment", pa.int32()), ("hashes", pa.binary())])
    found_schema = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def ask(documents: pa.Table) -> pa.Table:
        tokens, _ = token_hashes(texts_of(documents.combine_chunks()))
        block = documents["block"][0].as_py()
        asked = []
        for n, (grams, there) in enumerate(n_grams(tokens, order), 1):
            hashes = np.unique(grams if n == 1 else grams[there])
            asked += [(block, n, s, hashes[a:b].tobytes()) for s, a, b in _by_segment(hashes, segments)]
        return pa.Table.from_batches(_batches(asked, asked_schema), asked_schema)

    def answer(asked: pa.Table, piece: pa.Table) -> pa.Table:
        found = []
        for r in asked.to_pylist():
            hashes = np.frombuffer(r["hashes"], "<u8")
            counts = read_piece(r["n"], piece["data"][0].as_py(), hashes) if piece.num_rows else np.zeros(len(hashes), np.int64)
            found.append((r["block"], r["n"], r["hashes"], counts.astype("<i8").tobytes()))
        return pa.Table.from_batches(_batches(found, found_schema), found_schema)

    def score(documents: pa.Table, found: pa.Table) -> pa.Table:
        counts = {}
        for n in range(1, order + 1):
            of_n = [r for r in found.to_pylist() if r["n"] == n]
            hashes = np.frombuffer(b"".join(r["hashes"] for r in of_n), "<u8")
            by = np.argsort(hashes)
            counts[n] = hashes[by], np.frombuffer(b"".join(r["counts"] for r in of_n), "<i8")[by]
        read = lambda n, hashes: counts[n][1][np.searchsorted(counts[n][0], hashes)]
        scores = _document_scores(texts_of(documents.combine_chunks()), order, total, distinct, read)
        return pa.Table.from_arrays([*[documents[c] for c in own], *scores], names=[*own, *[c for c, _ in _SCORED]])

    asked = rows.groupBy("block").applyInArrow(ask, "block int, n int, segment int, hashes binary")
    found = asked.groupBy("n", "segment").cogroup(model.groupBy("n", "segment")).applyInArrow(answer, "block int, n int, hashes binary, counts binary")
    return rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, f"{_ddl(rows, own)}, {_SCORED_DDL}")


def scored(docs: DataFrame, held_out: str = HELD_OUT, order: int = ORDER, broadcast: int = BROADCAST) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the documents for which the SQL condition ``held_out`` does not hold.
    """
    prepared(docs.sparkSession)
    rows = docs.select("doc_id", F.expr(held_out).alias("held_out"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("size")).first().size
    segments = 1 + size // SEGMENT_BYTES
    model = cut(trained(rows.filter("NOT held_out"), segments, order))
    known = model.agg(
        *[F.coalesce(F.sum(F.when(F.col("n") == 1, F.col(c))), F.lit(0)).alias(c) for c in ("total", "entries")],
        F.coalesce(F.sum(F.octet_length("data").cast("bigint")), F.lit(0)).alias("size"),
    ).first()
    if known.size <= broadcast:
        out = _by_broadcast(rows, model, segments, order, known.total, known.entries)
    else:
        out = _by_blocks(rows, model, segments, order, known.total, known.entries, 1 + size // BLOCK_BYTES)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(known.total).cast("bigint").alias("train_tokens"), "base_score", "score")
