"""Align the tokens of two tokenizers over the same text.

Both tokenizers encode the whole text. Where a token of each ends at the same byte, the text can
be cut for both at once; such cuts make the finest groups of tokens that cover the same bytes.

A document is first cut at its anchors: single spaces with another character on either side,
none of it white space after it. There both tokenizers begin a new token, whatever stands around:
one never merges across the space before a word, and no token of the other has its space mark
anywhere but in front, or in a run of them. Between two anchors lies a window, which is about a
word; its ids and groups depend on its text alone, and words repeat, so each worker remembers the
windows it has encoded and aligned. A text with a window that a side doesn't give back, or with
white space that the tokenizers may see differently, is encoded and aligned whole.

A link is a pair of tokens, one of each tokenizer, that end together. How many links of all
documents hold an id pair needs the whole corpus: every document hands on its pairs with their
numbers, tasks fold them, and the totals go back to the documents by broadcast while the table of
pairs is below ``BROADCAST`` bytes (it is bounded by the vocabularies, not by the corpus), and by
a join with the pairs of each document beyond that.

Texts that are null, empty, or that one of the tokenizers does not give back byte by byte have no
tokens: zeros, and '' for the digest. Rows are aligned one by one, so a repeated or null doc_id
gives rows of its own; every row counts for the totals. An empty table gives no rows.
"""

import hashlib
import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut, prepared
from loomstead.llm.piece_cache import ODD_SPACE, SPACED, Pieces, packed_ids
from loomstead.session import join_per_key

#: Windows a worker remembers, in two generations, and the characters of the longest of them;
#: texts that are aligned together.
WINDOWS = 300_000
LONGEST_WINDOW = 48
TOGETHER = 256
BROADCAST = 128 << 20

#: An anchor, and what texts have where not every single space is one.
ANCHOR = re.compile(r"(?<![ ]) (?=[^\x20\x09-\x0D])")
NO_ANCHOR = re.compile(r"\A | (?=[\x20\x09-\x0D]|\Z)")


class ByteTokens:
    """Ids and token bytes of a byte-level tokenizer; special strings are plain text."""

    def __init__(self, path: str):
        self.pieces = Pieces(path, packed_ids, SPACED, lower=False, odd=ODD_SPACE)
        tokenizer = self.pieces.tokenizer
        tokenizer.encode_special_tokens = True
        self.pieces.specials = []
        back = {letter: byte for byte, letter in self.pieces.letters.items()}
        words = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.bytes = [bytes(back[c] for c in w) if all(c in back for c in w) else w.encode() for w in words]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        each = [b"".join(x) for x in self.pieces.each([f" {t}" for t in texts])]
        return np.frombuffer(b"".join(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each)) // 4


class MarkedTokens:
    """Ids and token bytes of a sentencepiece model, which puts a space mark before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)
        ]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self.model.encode(texts, num_threads=1)
        n = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), "<u4", int(n.sum())), n


class Window(NamedTuple):
    """What is remembered of a window: its tokens on either side, its groups as text, each with a
    ';' after it, and the id pairs that end together, each as eight bytes."""

    n_a: int
    n_b: int
    groups: bytes
    pairs: bytes


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), MarkedTokens(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes]) for t in (self.a, self.b))
        # an id as text: within its side, at the end of a group's first side, at a group's end
        n = max(len(self.a.bytes), len(self.b.bytes))
        self.width = n
        self.written = [str(i).encode() + mark for mark in (b",", b"|", b";") for i in range(n)]
        self.known: dict[str, Window | None] = {}
        self.before: dict[str, Window | None] = {}

    def given_back(self, side, ids: np.ndarray, n: np.ndarray, raw: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text are its bytes."""
        words = list(map(side.bytes.__getitem__, ids.tolist()))
        upto = np.cumsum(n).tolist()
        ends = np.cumsum([0, *map(len, words)])[upto]
        if b"".join(words) == b"".join(raw) and (ends == np.cumsum(list(map(len, raw)))).all():  # as a rule
            return np.ones(len(raw), bool)
        return np.array([b"".join(words[i:j]) == r for i, j, r in zip([0, *upto], upto, raw, strict=False)])

    def aligned(self, a: np.ndarray, b: np.ndarray):
        """Groups of two sides that cover the same bytes: ids as text in the order of the groups,
        the number of tokens of each side up to the end of each group, and the pair that ends it."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        marked = np.zeros((2, 1 + (ends_a[-1] if len(a) else 0)), bool)
        marked[0, ends_a], marked[1, ends_b] = True, True
        last_a, last_b = marked[1, ends_a], marked[0, ends_b]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        code_a = a.astype(np.int64) + self.width * last_a
        code_b = b.astype(np.int64) + 2 * self.width * last_b
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = list(map(self.written.__getitem__, np.concatenate([code_a, code_b])[order].tolist()))
        upto_a, upto_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        return texts, upto_a + 1, upto_b + 1, a[upto_a].astype("<i8") << 32 | b[upto_b]

    def whole(self, texts: list[str]) -> list[Window | None]:
        """Texts as windows, None where there are no tokens, all of them in one go: every text
        begins at a shared end."""
        if not texts:
            return []
        raw = [f" {t}".encode() for t in texts]
        (a, n_a), (b, n_b) = self.a.ids(texts), self.b.ids(texts)
        good = self.given_back(self.a, a, n_a, raw) & self.given_back(self.b, b, n_b, raw)
        a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a[good], n_b[good]
        parts, upto_a, upto_b, pairs = self.aligned(a, b)
        tokens = np.cumsum(n_a + n_b)
        groups = np.searchsorted(upto_a + upto_b, tokens, "left") + 1
        raw, t, g, out = pairs.tobytes(), 0, 0, []
        for x, y, t_end, g_end in zip(n_a.tolist(), n_b.tolist(), tokens.tolist(), groups.tolist(), strict=True):
            out.append(Window(x, y, b"".join(parts[t:t_end]), raw[8 * g : 8 * g_end]))
            t, g = t_end, g_end
        each = iter(out)
        return [next(each) if x else None for x in good.tolist()]

    def _learn(self, used: set[str]) -> list[str]:
        """Know all these windows; returned are those that are too long to be remembered."""
        if len(self.known) > WINDOWS // 2:
            self.before, self.known = self.known, {}
        new = []
        for w in used.difference(self.known):
            if w in self.before:
                self.known[w] = self.before[w]
            else:
                new.append(w)
        self.known.update(zip(new, self.whole(new), strict=True))
        return [w for w in new if len(w) > LONGEST_WINDOW]

    def of(self, texts: list[str | None]) -> list[tuple | None]:
        """Per text (tokens of a, tokens of b, groups, id pairs, digest), or None where there are none."""
        out = []
        for k in range(0, len(texts), TOGETHER):
            some = texts[k : k + TOGETHER]
            cuts = [(ANCHOR.split(t) if NO_ANCHOR.search(t) else t.split(" ")) if t and not ODD_SPACE.search(t) else None for t in some]
            long = self._learn(set().union(*filter(None, cuts)))
            found = [list(map(self.known.__getitem__, c)) if c else None for c in cuts]
            odd = [i for i, x in enumerate(found) if some[i] and (x is None or None in x)]
            for i, x in zip(odd, self.whole([some[i] for i in odd]), strict=True):
                found[i] = [x] if x else None
            for w in long:
                del self.known[w]
            for x in found:
                if x is None:
                    out.append(None)
                    continue
                n_a, n_b, groups, pairs = zip(*x, strict=True)
                pairs = np.frombuffer(b"".join(pairs), "<i8")
                out.append((sum(n_a), sum(n_b), len(pairs), pairs, hashlib.sha256(b"".join(groups)[:-1]).hexdigest()))
        return out


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a, b, times): the id pairs of the
    links of each document with the number of times it has them."""
    names = ["doc_id", *_COUNTS, "groups_sha256", "a", "b", "times"]

    def run(batches):
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            rows = []
            for found in aligner.of(batch.column("text").to_pylist()):
                if found is None:
                    rows.append((0, 0, 0, 0, "", [], [], []))
                else:
                    pairs, times = np.unique(found[3], return_counts=True)
                    rows.append((*found[:3], len(found[3]), found[4], pairs >> 32, pairs & 0xFFFFFFFF, times))
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 3
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            arrays = [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {counts}, groups_sha256 string, a array<int>, b array<int>, times array<int>"
    )


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The document each pair of a batch belongs to, the pair as one number, and its times."""
    a, b, times = (batch.column(c) for c in ("a", "b", "times"))
    sizes = a.value_lengths().to_numpy(zero_copy_only=False)
    pair = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()
    return np.repeat(np.arange(len(sizes)), sizes), pair, times.flatten().to_numpy().astype(np.int64)


def _folded(batches):
    """(pair, n) of a task, folded over some batches at a time."""
    pairs, numbers, size = [], [], 0

    def out():
        values, back = np.unique(np.concatenate(pairs), return_inverse=True)
        n = np.bincount(back, np.concatenate(numbers), len(values)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        _, pair, times = _flat(batch)
        pairs.append(pair)
        numbers.append(times)
        size += len(pair)
        if size > 4_000_000:
            yield out()
            pairs, numbers, size = [], [], 0
    if size:
        yield out()


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): links of all documents that hold an id pair (a in the upper 32 bits, b in
    the lower), and whether no pair with the same b has more."""
    counts = cut(rows.select("a", "b", "times").mapInArrow(_folded, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return join_per_key(counts, most, ["b"], "inner").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _by_broadcast(rows: DataFrame, counts: DataFrame) -> DataFrame:
    found = counts.orderBy("pair").toArrow()
    columns = [found[c].to_numpy() for c in ("pair", "n")] + [found["best"].to_numpy().astype(bool)]
    shared = rows.sparkSession.sparkContext.broadcast(columns)
    own = [c for c in rows.columns if c not in ("_at", "a", "b", "times")]

    def run(batches):
        known, n, best = shared.value
        for batch in batches:
            doc, pair, times = _flat(batch)
            at = np.searchsorted(known, pair)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], doc, times * best[at])
            np.add.at(sums[1], doc, times * n[at])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], *map(pa.array, sums)], names=[*own, "n_best", "count_sum"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in own)
    return rows.select(*own, "a", "b", "times").mapInArrow(run, f"{kinds}, n_best bigint, count_sum bigint")


def _by_join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    each = rows.select("_at", F.explode(F.arrays_zip("a", "b", "times")).alias("x")).select(
        "_at", F.shiftleft(F.col("x.a").cast("bigint"), 32).bitwiseOR(F.col("x.b").cast("bigint")).alias("pair"), "x.times"
    )
    sums = (
        join_per_key(each, counts, ["pair"], "inner")
        .groupBy("_at")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("n_best", "count_sum")}
    return rows.drop("a", "b", "times").join(sums, "_at", "left").withColumns(filled).drop("_at")


def alignments(docs: DataFrame, path_a: str, path_b: str, broadcast: int = BROADCAST) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    prepared(docs.sparkSession)
    rows = cut(aligned(docs, path_a, path_b).withColumn("_at", F.monotonically_increasing_id()))
    counts = cut(pair_counts(rows))
    out = (_by_broadcast if 17 * counts.count() <= broadcast else _by_join)(rows, counts)
    return out.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")
