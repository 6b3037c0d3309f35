"""Substring dedup: paragraph MinHash banding.

A paragraph here is a sentence or line: texts are cut after words that end in a full stop,
question or exclamation mark, at line ends, and stretches above ``LONG`` words after words whose
hash is the least of all within ``NEAR`` words. Every cut depends on the words around it only, so a passage that two documents share is
cut alike in both, wherever it stands. Paragraphs of ``LEAST_WORDS`` words or more take part.

Passages made of shorter ones (lists, verse, code, narrow lines) or wrapped otherwise are found
by windows: of every ``PICK`` shingles in a row the least begins a window of ``WINDOW`` words,
whatever lines or sentences it crosses. So every ``PICK + WINDOW - 1`` = 25 words that two
documents share hold a whole window, the same in both. Windows take part by equality alone.

Equal paragraphs are one content. Contents get MinHash values over shingles of five lower-cased
words, in ``BANDS`` bands of ``ROWS``: two with Jaccard similarity 0.8 share a band with a
probability of 1 - (1 - 0.8 ** ROWS) ** BANDS = 0.9998, with similarity 0.35 in one case of
five. Contents that collide are joined, their exact Jaccard similarity is computed, and components of the links are the classes. Of a class
that occurs in several documents, the first paragraph (by doc_id, then place) stays. The others
are marked, and marked paragraphs that follow each other, with little between them, are a
passage. It is extended at either end, word by word, as far as it agrees with the copy that
stays (up to ``CONTEXT`` words). Passages next to each other whose whole has a similarity of 0.8
to what stays are one (of 50 words at 0.8, 25 in a row are unchanged, so a window is among
them); it is removed if it has ``PASSAGE_WORDS`` words or more. Shorter repeats (a license
line, a heading) are left alone.

Texts are not moved to be compared. A first pass finds the contents and band keys that occur
twice; rows are only made of these, again from the texts. Bitmaps that grow with what they
announce, up to ``MOST_BITS``, tell the tasks; exact joins and counts follow, so a bitmap only
saves work. A band that many contents share is cut into parts, and no group grows with the corpus.

Nulls: a null text is empty and has no passages; a null doc_id orders last. Rows that repeat
both doc_id and text are one document. An empty table has no passages.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from loomstead.llm.common import IS_SPACE, cut, null_safe_key, texts_of, tidy
from loomstead.llm.groups import Sets, arranged, components, crowded, runs
from loomstead.session import join_per_key

SHINGLE = 5
ROWS, BANDS = 4, 16
LEAST_WORDS = 8
LONG, NEAR, HARD = 32, 8, 128
PICK, WINDOW = 12, 14
GAP_WORDS = 16
PASSAGE_WORDS = 30
CONTEXT = 64
GROUP = 128
SLOTS, MOST_BITS, SEGMENT = 16, 1 << 30, 1 << 19
SHIFTS = (0, 32)
SLICE, HELD = 1 << 19, 1 << 19
#: Band keys are counted by their upper bits; of the lower ones, so many tell contents apart.
TAG = np.uint64(24)
ENDS = np.frombuffer(b".?!", np.uint8)

_rng = np.random.default_rng(5)
_A = _rng.integers(1, 1 << 63, (ROWS * BANDS,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, (ROWS * BANDS,), dtype=np.uint64)
_M = np.uint64(0x9E3779B97F4A7C15)
# White space adds nothing to the word before it.
_OF_BYTE = np.where(IS_SPACE, np.uint64(0), _rng.integers(1, 1 << 63, 256, dtype=np.uint64))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word: random numbers of its bytes, weighted by place."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    power = np.cumprod(np.full(int((ends - starts).max()), _M))
    # Slices of some kilobytes: the intermediate arrays stay small, and in the processor's cache.
    cuts = np.unique(np.concatenate([np.searchsorted(starts, np.arange(0, int(ends[-1]), 1 << 16)), [len(starts)]]))
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        base, size = starts[i:j] - starts[i], ends[i:j] - starts[i:j]
        span = np.diff(np.append(base, ends[j - 1] - starts[i]))
        place = np.minimum(np.arange(int(span.sum())) - np.repeat(base, span), np.repeat(size, span) - 1)
        mixed = _OF_BYTE[data[starts[i] : ends[j - 1]]] * power[place]
        out[i:j] = np.add.reduceat(mixed, base) + size.astype(np.uint64)
    out = (out ^ (out >> np.uint64(32))) * _M
    return out ^ (out >> np.uint64(29))


def least_nearby(hashes: np.ndarray) -> np.ndarray:
    """Whether each hash is the least of those up to ``NEAR`` places before and after it; of
    equal ones it is the last."""
    if not len(hashes):
        return np.zeros(0, bool)
    top = np.full(NEAR, np.iinfo(np.uint64).max)
    wide = np.concatenate([top, hashes, top])
    windows = np.lib.stride_tricks.sliding_window_view(wide, NEAR)
    least = windows.min(axis=1)
    before, after = least[: len(hashes)], least[NEAR + 1 :]
    return (hashes <= before) & (hashes < after)


def paragraphs(ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of paragraphs, given where sentences and lines end; ``stops`` marks the
    words after which a long one may be cut."""
    starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
    long = np.flatnonzero(ends - starts > LONG)
    first, last = [np.delete(starts, long)], [np.delete(ends, long)]
    for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        inner = (np.flatnonzero(stops[start + LEAST_WORDS - 1 : end - LEAST_WORDS]) + start + LEAST_WORDS).tolist()
        edges = [start]
        for stop in [*inner, end]:
            edges += [*range(edges[-1] + HARD, stop, HARD), stop]
        first.append(np.array(edges[:-1], np.int64))
        last.append(np.array(edges[1:], np.int64))
    first, last = np.concatenate(first), np.concatenate(last)
    order = np.argsort(first)
    return first[order], last[order]


def windows(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place of the first word of each window, of texts with so many words."""
    text, ends = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths)
    keys = shingles_of(words)
    if len(keys) < PICK:
        return text[:0], text[:0]
    within = text[: len(keys) - PICK + 1] == text[PICK + SHINGLE - 2 :]
    begin = np.flatnonzero(within)
    sliding = np.lib.stride_tricks.sliding_window_view(keys, PICK)
    # A copy of all windows would be twelve times the words; some thousands at a time are copied.
    least = [sliding[begin[k : k + 16384]].argmin(axis=1) + begin[k : k + 16384] for k in range(0, len(begin), 16384)]
    place = np.unique(np.concatenate([*least, begin[:0]]))
    place = place[place + WINDOW <= ends[text[place]]]
    return text[place], place


def cut_up(texts: list[bytes]):
    """All paragraphs of a batch that take part: row, first word and number of words within
    the row, place of the first word in the batch; the batch's lower-cased words' hashes, and
    each row's number of words."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    space = IS_SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    words = _word_hashes(data, starts, ends)
    upto = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))
    lengths = np.diff(upto, prepend=0)
    # A sentence ends with a full stop or mark, a line with a line end before the next word.
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    over = np.isin(data[ends - 1], ENDS) | np.append(line[1:] != line[:-1], np.ones(min(len(line), 1), bool))
    place, stop = paragraphs(np.flatnonzero(over) + 1, least_nearby(words))
    some = stop - place >= LEAST_WORDS
    place, size = place[some], (stop - place)[some]
    row = np.searchsorted(upto, place, "right")
    return row, place - (upto - lengths)[row], size, place, words, lengths


def shingles_of(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words, whatever paragraphs they cross."""
    n = max(len(words) - SHINGLE + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = (out + words[k : n + k]) * _M
    return out ^ (out >> np.uint64(29))


def contents(words: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit number for the words of each paragraph, in their order."""
    upto = np.zeros(len(words) + 1, np.uint64)
    # Positions count within the paragraph, as powers of an odd number: sum(word * M ** place).
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(HARD + LONG, _M)]).astype(np.uint64))
    index = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    mixed = words[np.repeat(place, size) + index]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * power[index]
    sums = np.add.reduceat(mixed, np.cumsum(size) - size) if len(size) else upto[:0]
    sums = (sums ^ (sums >> np.uint64(32))) * _M + size.astype(np.uint64)
    return (sums ^ (sums >> np.uint64(29))).view(np.int64)


def bands(shingles: np.ndarray, place: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The band keys of each paragraph, one array per band; paragraphs come in order of place."""
    out = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(place), 1)
    ranges = np.column_stack([place, place + size - SHINGLE + 1])
    # Stretches of shingles that stay in the processor's cache while all hashes pass over them.
    cuts = np.unique(np.append(np.searchsorted(place, np.arange(0, len(shingles), 1 << 14)), len(place)))
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        a, z = int(ranges[i, 0]), int(ranges[i:j, 1].max())
        own = np.append(shingles[a:z], shingles[z - 1 : z])
        at, mixed = (ranges[i:j] - a).ravel(), np.empty_like(own)
        for k in range(ROWS * BANDS):
            np.multiply(own, _A[k], out=mixed)
            mixed += _B[k]
            key = out[k // ROWS, i:j]
            key += np.minimum.reduceat(mixed, at)[::2]
            key *= _M
            key ^= key >> np.uint64(29)
    return list(out.view(np.int64))


def _slices(batches):
    """The rows of batches with about ``SLICE`` bytes of text at a time: arrays over words take
    many times what the text does."""
    for batch in batches:
        size = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(size, dtype=np.int64) // SLICE
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
        for i, j in zip(edges, edges[1:], strict=False):
            if i < j:
                yield batch.slice(i, j - i)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), "text")


def _shards(docs: DataFrame) -> int:
    """Enough shards that one holds the numbers of about 8 MB of text."""
    return max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / (1 << 23)))


def tagged(keys: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Band keys (one row per band) whose lower bits are replaced by a hash of key and content:
    one content gives a key the same number wherever it occurs, others give it other numbers
    (but for about one pair in 2 ** 24, of each band they share anew)."""
    out = keys ^ content
    out *= _M
    out >>= np.uint64(64) - TAG
    out |= keys >> TAG << TAG
    return out


def counted_as(keys: np.ndarray) -> np.ndarray:
    """The upper bits of band keys, tagged or not, spread over 64 bits as bitmaps want them."""
    mixed = (keys >> TAG) * _M
    return mixed ^ (mixed >> np.uint64(32))


def _keys(words: np.ndarray, place: np.ndarray, size: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which paragraphs are the first of their content in a slice, and their band keys, one row per band."""
    some = np.sort(np.unique(content, return_index=True)[1])  # in order of place, as folding wants them
    return some, np.array(bands(shingles_of(words), place[some], size[some])).reshape(BANDS, -1).view(np.uint64)


def _twice(docs: DataFrame) -> DataFrame:
    """(kind, value): the contents that occur twice or more (kind 0), and the band keys, as
    ``counted_as`` has them, of two contents or more (kind 1): the keys of a content that is
    only repeated meet nothing. Numbers travel packed, a sorted run for each shard, and a task
    sends one at most twice, so a hot one is a few bytes of a task."""
    shards = _shards(docs)

    def run(batches):
        kept: list[list[np.ndarray]] = [[], []]
        held = 0

        def packed():
            for kind in (0, 1):
                value = np.sort(np.concatenate([*kept[kind], np.zeros(0, np.uint64)]))
                most = 2 - kind  # as a tagged band key says itself whether contents differ
                value = value[np.append(np.ones(min(most, len(value)), bool), value[most:] != value[:-most])]
                shard = ((value >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                edges = np.flatnonzero(np.diff(shard, prepend=-1))
                parts = [x.tobytes() for x in np.split(value, edges[1:])] if len(value) else []
                columns = [pa.array(shard[edges].astype(np.int32)), pa.array(np.full(len(edges), kind, np.int32)), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "kind", "numbers"])

        for batch in _slices(batches):
            _, _, size, place, words, lengths = cut_up(texts_of(batch))
            _, begin = windows(words, lengths)
            content = contents(words, place, size)
            kept[0] += [content.view(np.uint64), contents(words, begin, np.full(len(begin), WINDOW)).view(np.uint64)]
            some, keys = _keys(words, place, size, content)
            kept[1].append(tagged(keys, content[some].view(np.uint64)).ravel())
            held += len(begin) + len(place) + keys.size
            if held > HELD:
                yield from packed()
                kept, held = [[], []], 0
        yield from packed()

    def repeated(frame: pd.DataFrame) -> pd.DataFrame:
        kind, value = frame["kind"].iloc[0], np.sort(np.frombuffer(b"".join(frame["numbers"]), np.uint64))
        if kind == 0:
            again = value[1:][value[1:] == value[:-1]]
        else:  # equal upper bits, other tags
            again = value[1:][(value[1:] >> TAG == value[:-1] >> TAG) & (value[1:] != value[:-1])]
            again = counted_as(again)
        return pd.DataFrame({"kind": kind, "value": np.unique(again).view(np.int64)})

    sent = docs.select("text").mapInArrow(tidy(run), "shard int, kind int, numbers binary")
    return sent.groupBy("shard", "kind").applyInPandas(repeated, "kind int, value bigint")


def _found(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """The paragraphs and windows whose content the bitmap knows: doc_id, _text, first, size,
    content, and whether it is a window (``crossing``)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in _slices(batches):
            row, first, size, place, words, lengths = cut_up(texts_of(batch))
            text, begin = windows(words, lengths)
            if not len(row) + len(text):
                continue
            crossing = np.repeat([False, True], [len(row), len(text)])
            row, place = np.concatenate([row, text]), np.concatenate([place, begin])
            first = np.concatenate([first, begin - (np.cumsum(lengths) - lengths)[text]])
            size = np.concatenate([size, np.full(len(text), WINDOW)])
            content = contents(words, place, size)
            some = np.flatnonzero(_is_set(known, content))
            at = pa.array(row[some])
            columns = [batch.column("doc_id").take(at), batch.column("_text").take(at), pa.array(first[some].astype(np.int32))]
            columns += [pa.array(size[some].astype(np.int32)), pa.array(content[some]), pa.array(crossing[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "_text", "first", "size", "content", "crossing"])

    return _rows(docs).mapInArrow(tidy(run), f"doc_id {id_type}, _text bigint, first int, size int, content bigint, crossing boolean")


def _banded(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """(key, content): the band keys that the bitmap knows (by ``counted_as``), once with each content."""

    def run(batches):
        for batch in _slices(batches):
            row, first, size, place, words, _ = cut_up(texts_of(batch))
            content = contents(words, place, size)
            some, keys = _keys(words, place, size, content)
            band, at = np.nonzero(_is_set(known, counted_as(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[band, at].view(np.int64)), pa.array(content[some][at])], names=["key", "content"])

    return docs.select("text").mapInArrow(tidy(run), "key bigint, content bigint").distinct()


def _is_set(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bitmap has both bits of each number."""
    values, most = values.view(np.uint64), np.uint64(8 * len(bitmap) - 1)
    out = np.ones(values.shape, bool)
    for shift in SHIFTS:  # the second bit is only looked up where the first is set
        slot = (values[out] >> np.uint64(shift)) & most
        out[out] = (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _bitmap(some: DataFrame) -> np.ndarray:
    """Two bits for each value of a column of longs, of ``SLOTS`` bits a value, ``MOST_BITS`` at
    most. Each segment of ``SEGMENT`` bits is put together in a task of Spark."""
    some = some.toDF("value")
    bits = 1 << 16
    while bits < min(SLOTS * some.count(), MOST_BITS):
        bits *= 2

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(SEGMENT, bool)
        own[frame["slot"].to_numpy() % SEGMENT] = True
        return pd.DataFrame({"segment": [int(frame["slot"].iloc[0]) // SEGMENT], "bits": [np.packbits(own, bitorder="little").tobytes()]})

    both = ", ".join(f"shiftrightunsigned(value, {shift}) & {bits - 1}L" for shift in SHIFTS)
    slots = some.select(F.expr(f"explode(array({both}))").alias("slot")).distinct()
    parts = slots.groupBy(F.expr(f"slot DIV {SEGMENT}")).applyInPandas(run, "segment bigint, bits binary")
    out = np.zeros(max(bits, SEGMENT) // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[r["segment"] * SEGMENT // 8 :][: SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
    return out[: bits // 8]


def _where_known(rows: DataFrame, bitmap: np.ndarray, column: str, known: bool = True) -> DataFrame:
    """The rows whose column may be (or, with ``known`` false, can't be) in the bitmap."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_is_set(bitmap, batch.column(column).to_numpy()) == known))

    return rows.mapInArrow(tidy(run), rows.schema)


def _shingled(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(content, shingles) of the wanted contents (content): their distinct shingle hashes."""
    bitmap = _bitmap(wanted)

    def run(batches):
        for batch in _slices(batches):
            row, first, size, place, words, _ = cut_up(texts_of(batch))
            if not len(row):
                continue
            content = contents(words, place, size)
            some = np.flatnonzero(_is_set(bitmap, content))
            some = some[np.unique(content[some], return_index=True)[1]]
            if not len(some):
                continue
            values = shingles_of(words)
            sets = [np.unique(values[place[k] : place[k] + size[k] - SHINGLE + 1]).view(np.int64) for k in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(content[some]), pa.array(sets, pa.list_(pa.int64()))], names=["content", "shingles"]
            )

    found = docs.select("text").mapInArrow(tidy(run), "content bigint, shingles array<bigint>")
    return found.join(wanted, "content", "left_semi").groupBy("content").agg(F.first("shingles").alias("shingles"))


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets have a Jaccard similarity of 0.8 or more, exactly."""
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    table = np.zeros((len(sets), len(values)), np.float32)
    table[np.repeat(np.arange(len(sets)), sizes), at] = 1
    both = np.rint(table @ table.T).astype(np.int64)
    return 5 * both >= 4 * (sizes[:, None] + sizes[None, :] - both)


def alike_pairs(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For sets of so many values, one after the other, whether the first and the second, the
    third and the fourth, ... have a Jaccard similarity of 0.8 or more, exactly."""
    total = sizes[::2] + sizes[1::2]
    pair = np.repeat(np.arange(len(total)), total)
    order = np.lexsort((values, pair))
    values, pair = values[order], pair[order]
    both = np.bincount(pair[1:][(values[1:] == values[:-1]) & (pair[1:] == pair[:-1])], minlength=len(total))
    return 5 * both >= 4 * (total - both)


def _linked(batches):
    """A spanning forest of each group's links between different contents. Most groups are
    pairs; these are compared together."""
    names = ["a", "b"]
    pairs: list[dict] = []

    def of_pairs():
        if pairs:
            sets = [x for run in pairs for x in run["shingles"]]
            same = alike_pairs(np.concatenate(sets), np.array([len(x) for x in sets]))
            ends = np.array([run["content"] for run in pairs])[same]
            pairs.clear()
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=names)

    for run in runs(batches):
        n = len(run["content"])
        if n < 2 or (apart := run["lo"][0] != run["hi"][0]) and (run["part"] == run["part"][0]).all():
            continue
        if n == 2:
            pairs.append(run)
            if len(pairs) == 1024:
                yield from of_pairs()
            continue
        alike = similar(list(run["shingles"]))
        if apart:
            alike &= run["part"][:, None] != run["part"][None, :]
        sets, left, right = Sets(n), [], []
        for i, j in zip(*np.nonzero(np.triu(alike, 1)), strict=True):
            if sets.join(int(i), int(j)):
                left.append(int(run["content"][i]))
                right.append(int(run["content"][j]))
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=names)
    yield from of_pairs()


def _classes(docs: DataFrame) -> DataFrame:
    """The paragraphs whose class occurs in several documents, with class and place."""
    twice = cut(_twice(docs))
    close = cut(crowded(_banded(docs, _bitmap(twice.filter("kind = 1").select("value")))))
    wanted = cut(close.select("content").distinct())
    fat = close.join(cut(_shingled(docs, wanted)), "content")
    links = arranged(fat, "content", GROUP).mapInArrow(tidy(_linked), "a bigint, b bigint")
    roots = cut(components(links))
    # Only paragraphs and windows that may belong to a class of several documents are written.
    may = twice.filter("kind = 0").select("value").unionByName(roots.select(F.col("node").alias("value")))
    found = cut(_found(docs, _bitmap(may)))
    rooted = found.select("content", F.xxhash64("doc_id", "_text").alias("_doc"))
    rooted = rooted.join(roots, rooted["content"] == roots["node"], "left")
    several = rooted.groupBy(F.coalesce("root", "content").alias("class")).agg(F.min("_doc").alias("a"), F.max("_doc").alias("z"))
    several = cut(several.filter("a <> z").select("class"))
    # The contents of such classes: the class's own, and those whose root it is.
    members = roots.select(F.col("node").alias("content"), F.col("root").alias("class"))
    alone = several.join(roots, several["class"] == roots["node"], "left_anti").select(F.col("class").alias("content"), "class")
    repeated = cut(members.join(several, "class").select("content", "class").unionByName(alone))
    some = _where_known(found, _bitmap(repeated.select("content")), "content")
    return cut(some.join(repeated, "content").select("doc_id", "_text", "first", "size", "crossing", "class"))


def marked_paragraphs(docs: DataFrame) -> DataFrame:
    """Paragraphs of classes that occur in several documents: doc_id, _text, first, size, class,
    their ``place``, and ``kept``, the place of the class's first paragraph."""
    marked = _classes(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text", "first", "size")
    kept = marked.groupBy("class").agg(F.min(place).alias("kept"))
    # A place is put together after the join, so that nothing is moved twice.
    return join_per_key(marked, kept, ["class"], "inner").withColumn("place", place)


def stretches(first: list[int], size: list[int], docs: list) -> list[tuple]:
    """Fold a document's marked paragraphs, in order, into stretches with little in between:
    first and last word, the numbers of the first and the last paragraph and of that whose copy
    is the tail, the documents of the copies (``docs`` has each paragraph's), and ``lost``."""
    out, begin, until, head, tail, lost = [], 0, 0, 0, 0, 0
    for k, (place, n) in enumerate(zip(first, size, strict=True)):
        gap = place - until
        if k and gap <= GAP_WORDS:
            lost += gap + SHINGLE - 1 if gap > 0 else 0
            # A paragraph that ends within the stretch leaves its last one last.
            if place + n >= until:
                until, tail = place + n, k
            continue
        if k:
            out.append((begin, until, head, k, tail, list(dict.fromkeys(docs[head:k])), lost))
        begin, until, head, tail, lost = place, place + n, k, k, 0
    if len(first):
        out.append((begin, until, head, len(first), tail, list(dict.fromkeys(docs[head:])), lost))
    return out


def as_one(a: dict, b: dict) -> dict | None:
    """Two extended stretches that follow each other as one, if nothing is between them or the
    whole has a Jaccard similarity of 0.8 to its copy. ``lost`` counts shingles that the copy
    may lack, ``more`` the words it has more. Between copies in different documents there is
    nothing to compare with; as many words are counted there as here."""
    gap = max(b["first"] - a["until"], 0)
    end, start = a["tail"], b["head"]
    other = gap
    if (end["doc_id"], end["_text"]) == (start["doc_id"], start["_text"]):
        other = abs(b["kept_first"] - a["kept_until"])
    until = max(a["until"], b["until"])
    lost, more = a["lost"] + b["lost"] + gap + SHINGLE - 1, a["more"] + b["more"] + other - gap
    own = until - a["first"] - SHINGLE + 1
    both = own - lost
    if gap and 5 * both < 4 * (own + own + more - both):
        return None
    if not gap:
        lost, more = a["lost"] + b["lost"], a["more"] + b["more"]
    last = a if a["until"] > b["until"] else b
    return a | {
        "until": until, "tail": last["tail"], "kept_until": last["kept_until"], "lost": lost, "more": more,
        "classes": a["classes"] + b["classes"], "docs": list(dict.fromkeys(a["docs"] + b["docs"])),
    }


def joined(parts: list[dict]) -> list[dict]:
    """The extended stretches of a document, in order, as passages."""
    out: list[dict] = []
    for p in parts:
        out.append(p | {"more": 0})
        while len(out) > 1 and (one := as_one(*out[-2:])):
            out[-2:] = [one]
    return out


def _listed(rows: DataFrame, of_list, schema: str, parts) -> DataFrame:
    """``of_list`` of the sorted list of each document's ``parts``, one row per dict it gives."""
    own = rows.groupBy("doc_id", "_text").agg(F.array_sort(F.collect_set(parts)).alias("parts"))
    names = rows.sparkSession.createDataFrame([], schema)
    kinds = to_arrow_schema(names.schema)

    def run(batches):
        for batch in batches:
            found = [of_list(x) for x in batch.column("parts").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            columns = [batch.column("doc_id").take(at), batch.column("_text").take(at)]
            columns += [pa.array([x[k.name] for own in found for x in own], k.type) for k in list(kinds)[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=kinds.names)

    return own.mapInArrow(tidy(run), schema)


def changes(rows: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Whether each row but the first differs from the row before it in any of the columns; nulls are equal."""
    out = np.zeros(max(rows.num_rows - 1, 0), bool)
    for column in map(rows.column, names):
        a, b = column.slice(0, len(out)), column.slice(1)
        one = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(a.is_null(), b.is_null()))
        out |= one.to_numpy(zero_copy_only=False)
    return out


def _stretches(marked: DataFrame) -> DataFrame:
    """The stretches of marked paragraphs: first and until, the kept places of the first and
    the last paragraph, all classes and the documents that keep them. Kept places stay in Arrow."""
    kept, id_type = (marked.schema[n].dataType.simpleString() for n in ("kept", "doc_id"))
    schema = f"doc_id {id_type}, _text bigint, first int, until int, head {kept}, tail {kept}, classes array<bigint>, docs array<{id_type}>, lost int"
    kinds = to_arrow_schema(marked.sparkSession.createDataFrame([], schema).schema)
    names = ["doc_id", "_text", "first", "size", "class", "kept"]

    def folded(rows: pa.RecordBatch, edges: list[int]):
        """The stretches of whole documents, that begin at the edges."""
        begins, sizes = (rows.column(n).to_pylist() for n in ("first", "size"))
        own, copies = rows.column("class"), rows.column("kept")
        docs = copies.field("doc_id").to_pylist()
        found = [(i, x) for i, j in zip(edges, edges[1:], strict=False) for x in stretches(begins[i:j], sizes[i:j], docs[i:j])]
        at = pa.array([i for i, _ in found], pa.int64())
        ints = [pa.array([x[n] for _, x in found], pa.int32()) for n in (0, 1, 6)]
        ends = [copies.take(pa.array([i + x[n] for i, x in found], pa.int64())).cast(kinds.field("head").type) for n in (2, 4)]
        # A document's stretches take its paragraphs in a row, so their classes are one array cut up.
        cuts = pa.array([*[i + x[2] for i, x in found], len(own)], pa.int32())
        classes = pa.ListArray.from_arrays(cuts, own).cast(kinds.field("classes").type)
        kept_in = pa.array([x[5] for _, x in found], kinds.field("docs").type)
        columns = [rows.column("doc_id").take(at), rows.column("_text").take(at), *ints[:2], *ends, classes, kept_in, ints[2]]
        return pa.RecordBatch.from_arrays(columns, names=kinds.names)

    def run(batches):
        rest = None  # of the last document so far
        for batch in batches:
            rows = batch if rest is None else pa.concat_batches([rest, batch])
            other = changes(rows, ["doc_id", "_text"])
            # A repeated document's paragraphs come in copies side by side.
            once = np.append(True, other | changes(rows, ["first", "size", "class"]))
            rows, other = rows.filter(pa.array(once)), np.append(True, other)[once]
            edges = np.flatnonzero(other).tolist()
            rest = rows.slice(edges[-1])
            if len(edges) > 1:
                yield folded(rows.slice(0, edges[-1]), edges)
        if rest is not None:
            yield folded(rest, [0, rest.num_rows])

    rows = marked.select(F.xxhash64("doc_id", "_text").alias("_doc"), *names)
    rows = rows.repartition("_doc").sortWithinPartitions("_doc", *names[:-1])
    return rows.select(*names).mapInArrow(tidy(run), schema)


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The hashes of up to ``CONTEXT`` words before (way -1, nearest first) or after (way 1)
    the wanted places (doc_id, _text, pos, way). Only texts that a bitmap of bounded size knows
    are moved, and a text meets the list of its own places, which its length bounds."""
    by_doc = wanted.groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")).agg(
        F.array_sort(F.collect_set(F.struct("pos", "way"))).alias("places")
    )
    some = _where_known(_rows(docs), _bitmap(wanted.select("_text")), "_text")
    met = some.join(by_doc, some["doc_id"].eqNullSafe(by_doc["_id"]) & (some["_text"] == by_doc["_hash"]))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            at, pos, way, context = [], [], [], []
            for k, (text, places) in enumerate(zip(texts_of(batch), batch.column("places").to_pylist(), strict=True)):
                words = text.lower().split()
                for x in places:
                    p = x["pos"]
                    near = words[p : p + CONTEXT] if x["way"] > 0 else words[max(0, p - CONTEXT) : p][::-1]
                    at.append(k)
                    pos.append(p)
                    way.append(x["way"])
                    context.append(np.array([digest(w) for w in near], np.uint64).view(np.int64))
            ids = pa.array(at, pa.int64())
            columns = [batch.column("doc_id").take(ids), batch.column("_text").take(ids)]
            columns += [pa.array(pos, pa.int32()), pa.array(way, pa.int32()), pa.array(context, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "_text", "pos", "way", "context"])

    schema = f"doc_id {id_type}, _text bigint, pos int, way int, context array<bigint>"
    out = met.select(some["doc_id"], some["_text"], "text", "places").mapInArrow(tidy(run), schema)
    return out.dropDuplicates(["doc_id", "_text", "pos", "way"])


def passages(docs: DataFrame) -> DataFrame:
    """The passages to remove: doc_id, _text, first word, the word after the last, the classes
    of the paragraphs and the documents in which their first copies stay."""
    marked = marked_paragraphs(docs).filter("place <> kept")
    # Windows overlap; of a text that repeats itself they must not take what stays.
    marked = marked.filter("NOT crossing OR place.doc_id IS DISTINCT FROM kept.doc_id OR place._text <> kept._text")
    found = cut(_stretches(marked))
    ends = {
        "own_head": ("doc_id", "_text", F.col("first"), -1), "own_tail": ("doc_id", "_text", F.col("until"), 1),
        "kept_head": ("head.doc_id", "head._text", F.col("head.first"), -1),
        "kept_tail": ("tail.doc_id", "tail._text", F.col("tail.first") + F.col("tail.size"), 1),
    }
    wanted = None
    for doc, text, pos, way in ends.values():
        one = found.select(F.col(doc).alias("doc_id"), F.col(text).alias("_text"), pos.alias("pos"), F.lit(way).alias("way"))
        wanted = one if wanted is None else wanted.unionByName(one)
    contexts = cut(_contexts(docs, cut(wanted.distinct())).select(null_safe_key("doc_id").alias("_doc"), "_text", "pos", "way", "context"))
    rows = found
    for name, (doc, text, pos, way) in ends.items():
        side = contexts.filter(F.col("way") == way).select(
            F.col("_doc").alias("_d"), F.col("_text").alias("_t"), F.col("pos").alias("_p"), F.col("context").alias(name)
        )
        key = F.to_json(F.struct(F.col(doc).alias("doc_id")))
        rows = rows.join(side, (key == F.col("_d")) & (F.col(text) == F.col("_t")) & (pos == F.col("_p")), "left").drop("_d", "_t", "_p")

    def agreeing(a: str, b: str):
        differs = f"array_position(zip_with({a}, {b}, (x, y) -> coalesce(x = y, false)), false)"
        return F.expr(f"CAST(coalesce(IF({differs} > 0, {differs} - 1, least(size({a}), size({b}))), 0) AS INT)")

    head, tail = agreeing("own_head", "kept_head"), agreeing("own_tail", "kept_tail")
    parts = F.struct(
        (F.col("first") - head).alias("first"), (F.col("until") + tail).alias("until"), "head", "tail",
        (F.col("head.first") - head).alias("kept_first"), (F.col("tail.first") + F.col("tail.size") + tail).alias("kept_until"),
        "classes", "docs", "lost",
    )
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _text bigint, {found.select('first', 'until', 'classes', 'docs').schema.simpleString()[7:-1]}"
    whole = _listed(rows, joined, schema, parts)
    return whole.filter(f"until - first >= {PASSAGE_WORDS}").select("doc_id", "_text", "first", "until", "classes", F.col("docs").alias("kept"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per passage that goes: doc_id, first_word, n_words, kept_doc_ids, classes."""
    return passages(docs).select(
        "doc_id", F.col("first").alias("first_word"), (F.col("until") - F.col("first")).alias("n_words"),
        F.array_sort("kept").alias("kept_doc_ids"), F.array_sort(F.array_distinct("classes")).alias("class_ids"),
    )


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text less the given word ranges; of the white space around a range the first stays."""
    starts, at = [], 0
    for word in text.split():
        at = text.index(word, at)
        starts.append((at, at + len(word)))
        at += len(word)
    out, done = [], 0
    for a, b in sorted(spans):
        out.append(text[done : starts[a][0]])  # nothing, where a span overlaps the one before
        done = max(done, starts[b][0] if b < len(starts) else len(text))
    return b"".join([*out, text[done:]])


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages, with all columns; a document of which
    nothing is left goes."""
    spans = passages(docs).groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")).agg(
        F.array_sort(F.collect_set(F.struct("first", "until"))).alias("_spans")
    )
    # All columns travel in one struct, so that none can clash with those added here.
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    whole = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), columns)
    spans = cut(spans)
    bitmap = _bitmap(spans.select("_hash"))
    # Only texts that may lose something are moved.
    rest = _where_known(whole, bitmap, "_hash", known=False).select("_row.*")
    some = _where_known(whole, bitmap, "_hash")
    rows = some.join(spans, some["_row"]["doc_id"].eqNullSafe(spans["_id"]) & (some["_hash"] == spans["_hash"]), "left")
    rows, names = rows.select("_row", "_spans"), docs.columns

    def run(batches):
        for batch in batches:
            columns, lists = batch.column("_row").flatten(), batch.column("_spans").to_pylist()
            texts = columns[names.index("text")].to_pylist()
            gone = [bool(s) for s in lists]
            new = [
                without(t.encode(), [(x["first"], x["until"]) for x in s]).decode() if s else t
                for t, s in zip(texts, lists, strict=True)
            ]
            keep = pa.array([not g or bool(t.split()) for t, g in zip(new, gone, strict=True)])
            columns[names.index("text")] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    return rest.union(rows.mapInArrow(tidy(run), docs.schema))
