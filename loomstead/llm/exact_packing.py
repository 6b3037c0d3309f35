"""Best-fit packing of token sequences by exact-complement hashing.

Documents become pieces of at most ``CAPACITY`` tokens. Only the number of pieces of each
length matters for the packing, so the lengths are counted and the plan is made on the counts:
a table of at most ``CAPACITY`` numbers, whatever the corpus. First come the combinations that
fill a sequence exactly: single lengths, pairs and triples, looked up in an index of length
sums by their complement and consumed as often as the counts allow. Then the rest is placed by
best fit, longest first, into the tightest gap; pieces of one length and gaps of one size are
placed many at a time.

A plan is a list of patterns (lengths of one sequence) with multiplicities, so its size is
bounded by the capacity as well, and it may be sent to every task. There the k-th piece of a
length finds its sequence and offset by bisection. Ranks within a length are counted in hashed
buckets, whose number grows with the input, so a length that a third of the pieces share is
spread out.

A null text is empty: its document is the separator alone. Rows with repeated ids are
documents of their own. An empty table gives no pieces.
"""

import math
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut, texts_of, tidy
from loomstead.llm.piece_cache import id_bytes

CAPACITY = 2048
SEPARATOR = 0
BUCKET_ROWS = 20_000


def exact_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of one, two and three lengths that fill a sequence, with how many of each;
    ``counts`` loses what they use. Long lengths go first, as they are the hardest to place."""
    out = []

    def take(lengths: tuple[int, ...]) -> None:
        times = min(counts.get(n, 0) // lengths.count(n) for n in set(lengths))
        if times:
            out.append((lengths, times))
            for n in lengths:
                counts[n] -= times
                if not counts[n]:
                    del counts[n]

    take((capacity,))
    for n in sorted(counts, reverse=True):
        if 2 * n >= capacity and n in counts and capacity - n in counts:
            take((n, capacity - n))
    for n in sorted(counts, reverse=True):
        gap = capacity - n
        for m in [m for m in sorted(counts, reverse=True) if m <= n and 2 * m >= gap and gap - m > 0]:
            if n not in counts:
                break
            if m in counts and gap - m in counts:
                take((n, m, gap - m))
    return out


def best_fit_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, longest first, on counts. Patterns are runs (length, how many)."""
    bins: dict[int, list[list]] = {}  # gap -> [[runs, how many sequences]]
    gaps: list[int] = []
    done: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def put(runs: tuple, gap: int, times: int) -> None:
        if gap == 0:
            done.append((runs, times))
            return
        if gap not in bins:
            bins[gap] = []
            insort(gaps, gap)
        bins[gap].append([runs, times])

    def more(runs: tuple, n: int, k: int) -> tuple:
        if runs and runs[-1][0] == n:
            return (*runs[:-1], (n, runs[-1][1] + k))
        return (*runs, (n, k))

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = bisect_left(gaps, n)
            if at < len(gaps):
                gap = gaps[at]
                runs, times = bins[gap].pop()
            else:
                gap, runs, times = capacity, (), max(1, math.ceil(left / (capacity // n)))
            if at < len(gaps) and not bins[gap]:
                del bins[gap]
                gaps.pop(at)
            # As many of this length as a sequence takes go in one after the other: after the
            # first, its gap is the tightest or tied.
            fits = gap // n
            full = min(times, left // fits)
            if full:
                put(more(runs, n, fits), gap - n * fits, full)
                left -= full * fits
            if full < times:
                rest = times - full
                if left:
                    put(more(runs, n, left), gap - n * left, 1)
                    rest, left = rest - 1, 0
                if rest and runs:
                    put(runs, gap, rest)
    for gap in gaps:
        done += [(runs, times) for runs, times in bins[gap]]
    return done


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: slots (length, first rank, pieces per sequence,
    first sequence, first offset), sorted by length and rank; the k-th piece of a length, less
    the slot's first rank, divided by the pieces per sequence gives its sequence."""
    counts = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = {}
    slots, sequence = [], 0
    exact = exact_patterns(counts, capacity)
    runs = [(tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True)), times) for lengths, times in exact]
    for pattern, times in [*runs, *best_fit_patterns(counts, capacity)]:
        offset = 0
        for n, each in pattern:
            slots.append((n, used.get(n, 0), each, sequence, offset))
            used[n] = used.get(n, 0) + each * times
            offset += n * each
        sequence += times
    slots.sort()
    columns = zip(*slots, strict=True) if slots else ([],) * 5
    return dict(zip(("length", "rank", "each", "sequence", "offset"), (np.array(c, np.int64) for c in columns), strict=True))


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length and the CRC-32 of its ids."""
    end = np.array([separator], "<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = id_bytes(path)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(encoder.ids(texts_of(batch))):
                data = ids + end
                for p, s in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[s : s + 4 * capacity]
                    at.append(k)
                    piece.append(p)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            columns = [pa.array(piece, pa.int32()), *[pa.array(c, pa.int64()) for c in (start, length, crc)]]
            ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {id_type}, {PIECES}")


def placed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of at most ``capacity``."""
    buckets = max(1, math.ceil(rows.count() / BUCKET_ROWS))
    bucket = F.expr(f"pmod(xxhash64({', '.join(f'`{c}`' for c in rows.columns)}), {buckets})")
    dealt = cut(rows.withColumn("_bucket", bucket).repartition("length", "_bucket").sortWithinPartitions("length", "_bucket"))
    sizes = cut(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = plan(counts, capacity)  # a bounded table: one entry per length and pattern
    before = "sum(_n) OVER (PARTITION BY length ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    firsts = sizes.selectExpr("length", "_bucket", f"coalesce({before}, 0) AS _first")
    ranked = dealt.join(firsts, ["length", "_bucket"]).selectExpr(
        *rows.columns, f"_first + row_number() OVER (PARTITION BY length, _bucket ORDER BY {', '.join(f'`{c}`' for c in rows.columns)}) - 1 AS _rank"
    )

    def run(batches):
        span = 1 << 48  # lengths and ranks as one sorted number
        keys = slots["length"] * span + slots["rank"]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "_rank"))
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            inside = rank - slots["rank"][at]
            sequence = slots["sequence"][at] + inside // slots["each"][at]
            offset = slots["offset"][at] + inside % slots["each"][at] * length
            names = [n for n in batch.schema.names if n != "_rank"]
            arrays = [*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    schema = rows.limit(0).selectExpr("*", "0L AS sequence_id", "0L AS offset").schema
    return ranked.mapInArrow(tidy(run), schema)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents: one row per piece, with its sequence and offset."""
    return placed(cut(pieces(docs, path, capacity)), capacity)
