"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are words and stems of a lexicon, found by their log odds in the labelled training rows
(a stem is the beginning of several words, and must make up a share of the text), and patterns (shouting, exclamation marks, symbols, repetition). What they vote on a document is
one number, a bit per voter. The label model explains all documents' votes by a hidden class:
each voter has a rate per class, found by expectation maximisation over the counted vote
patterns, with the training labels counted in. Voters that go together within a class beyond
their rates are correlated; their evidence is discounted by the correlations found, so that ten
echoes don't count as ten witnesses. The posterior labels then train a logistic regression on
word presence and patterns, on a sample of at most ``SAMPLE`` rows; it scores whole texts.

Corpus statistics run over all rows as sums of fixed size. Language, source, ids and labels are
no inputs of a score. Only rows with crc32(doc_id) mod 4 other than 2 lend their labels.

Nulls: a null text is empty and scores by the intercept alone; null labels or ids lend no
label, a null id is not held out. Without labelled rows of both classes there are no word
voters and every score is 0. Rows with repeated ids are scored one by one.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import cut, with_columns

WORDS = 48
LEAST_SHARE = 0.01
#: A cue enters the lexicon if it is more frequent in toxic texts by so many deviations.
LEAST_G = 5.0
#: Correlations within a class below this are taken for chance.
CHANCE = 0.15
#: Labelled training rows used, at most: those whose ids hash lowest.
LABELLED = 20_000
#: Stems are word beginnings of these lengths, and count if every so manieth word has them.
STEMS = (4, 5, 6, 7)
STEM_WORDS = 120
PATTERNS = 5
EM_STEPS = 8
#: What all unlabelled rows together weigh against the labelled ones.
UNLABELLED = 0.3
SAMPLE = 8000
LEAST_ROWS = 4
VOCABULARY = 4000
L2 = 2e-3
STEPS = 400
THRESHOLD = 0.3

LETTERS = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _stem_cues(counts, n: int, of_words) -> set[str]:
    found: dict[str, int] = {}
    for w in of_words:
        for k in STEMS:
            if len(w) > k:
                found[w[:k]] = found.get(w[:k], 0) + counts[w]
    return {f"{stem}*" for stem, c in found.items() if c * STEM_WORDS >= n}


def cues(words: list[str]) -> set[str]:
    """The words of a text, and as ``stem*`` the stems with a share of it."""
    counts = Counter(words)
    return counts.keys() | _stem_cues(counts, len(words), counts)


class Known:
    """Finds a given set of cues in texts, looking closer only at words that may hold one."""

    def __init__(self, wanted):
        self.words = {c for c in wanted if not c.endswith("*")}
        self.stems = {c for c in wanted if c.endswith("*")}
        self.heads = {c[: STEMS[0]] for c in self.stems}

    def among(self, words: list[str]) -> set[str]:
        counts, heads, k = Counter(words), self.heads, STEMS[0]
        near = [w for w in counts if w[:k] in heads]
        return (self.words & counts.keys()) | (self.stems & _stem_cues(counts, len(words), near))


def speaking(with_cue: np.ndarray, without: np.ndarray, size: tuple[float, float]) -> np.ndarray:
    """Signed roots of the likelihood ratio of cues between two classes of the given sizes:
    about the standard deviations by which a cue is more frequent in the first class."""
    a, b = np.asarray(with_cue, float), np.asarray(without, float)
    table = [a, b, size[0] - a, size[1] - b]
    total = max(size[0] + size[1], 1)
    rows = [(a + b) * n / total for n in size] + [(total - a - b) * n / total for n in size]
    parts = [np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0) for o, e in zip(table, rows, strict=True)]
    return np.sign(a - rows[0]) * np.sqrt(np.maximum(2 * sum(parts), 0))


def patterns(text: str, words: list[str]) -> list[float]:
    """Strengths from 0 to 1 of the pattern voters; one votes if above a half."""
    n = max(len(text), 1)
    upper = sum(map(str.isupper, text)) / n
    return [
        min(1.0, 2 * upper), min(1.0, 25 * text.count("!") / n), min(1.0, 10 * sum(map(text.count, "#*$%&|<>")) / n),
        float(len(words) > 20 and 2 * len(set(words)) < len(words)), float(len(words) < 10),
    ]


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _lowest(rows: DataFrame, n: int, total: int) -> DataFrame:
    """The ``n`` rows whose doc_id hashes lowest, of about ``total``."""
    share = min(1.0, 2 * n / max(total, 1))
    placed = rows.withColumn("_place", F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)))
    return placed.filter(F.expr(f"pmod(_place, 1000000) < {round(1_000_000 * share)}")).orderBy("_place").limit(n).drop("_place")


def _known(labels: DataFrame) -> DataFrame:
    """The training labels used: (doc_id, toxic) of ``LABELLED`` ids; of several the largest."""
    good = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    one = cut(good.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    return cut(_lowest(one, LABELLED, one.count()))


def _summed(rows: DataFrame, shape: tuple[int, ...], of_batch, *columns: str) -> np.ndarray:
    """The sum over all rows of arrays of one fixed shape; each partition sends one."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            total += of_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["part"])

    total = np.zeros(int(np.prod(shape)))
    for row in rows.select(*columns).mapInArrow(run, "part array<double>").toLocalIterator():
        total += row["part"]
    return total.reshape(shape)


def lexicon(train: DataFrame) -> list[str]:
    """The cues that speak most for a toxic text, from training rows (text, toxic)."""

    def counted(batches):
        for batch in batches:
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for t, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found[toxic].update(cues(tokens(t or "")))
            names = sorted(found[0].keys() | found[1].keys())
            columns = [pa.array(names, pa.string()), *[pa.array([found[y][c] for c in names], pa.int64()) for y in (1, 0)]]
            yield pa.RecordBatch.from_arrays(columns, names=["cue", "n", "without"])

    size = train.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not all(size):
        return []
    size = tuple(size)
    common = train.select("text", "toxic").mapInArrow(counted, "cue string, n bigint, without bigint")
    common = common.groupBy("cue").agg(F.sum("n").alias("n"), F.sum("without").alias("without"))
    common = common.filter(F.col("n") >= max(2, LEAST_SHARE * size[0]))
    ratio = with_columns(common, "z double", lambda batch: {"z": speaking(batch.column("n").to_numpy(), batch.column("without").to_numpy(), size)})
    chosen: list[str] = []
    # Until the lexicon is full: cues that begin like a chosen one make room for those after them.
    for r in cut(ratio.filter(F.col("z") >= LEAST_G)).orderBy(F.desc("z"), "cue").toLocalIterator():
        cue = r["cue"]
        if len(chosen) == WORDS:
            break
        own = cue.rstrip("*")
        if not any(own.startswith(c.rstrip("*")) or c.startswith(own) for c in chosen):
            chosen.append(cue)
    return chosen


def voted(texts: list[str], words: list[str]) -> np.ndarray:
    """The votes on each text as bits: first the lexicon's cues, then the patterns."""
    bit, known, out = {w: 1 << k for k, w in enumerate(words)}, Known(words), []
    for text in texts:
        found = tokens(text)
        bits = sum(map(bit.__getitem__, known.among(found)))
        for k, s in enumerate(patterns(text, found)):
            bits |= (s > 0.5) << (len(words) + k)
        out.append(bits)
    return np.array(out, np.int64)


def unpacked(bits: np.ndarray, m: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(m) & 1).astype(float)


class LabelModel:
    """Class rates of binary voters and their correlations within the classes. A voter that is
    silent abstains: it is no evidence either way. ``prior`` is the log odds of a row with some
    vote of the lexicon before it is heard, ``silent`` those of a row without any."""

    def __init__(self, m: int):
        self.m, self.prior, self.silent = m, 0.0, 0.0
        self.rates = np.full((2, m), 0.5)
        self.corr = np.zeros((m, m))

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """A voter counts the less, the more the others who vote with it correlate with it."""
        worth = 1 / (1 + votes @ self.corr)
        heard = votes[:, : self.m - PATTERNS].any(axis=1)
        return np.where(heard, self.prior, self.silent) + (votes * worth) @ np.log(self.rates[1] / self.rates[0])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -40, 40)))

    def moments(self, votes: np.ndarray, share: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Per class: sums of one, of votes and of products of votes, as one array."""
        out = np.zeros((2, self.m + 1, self.m + 1))
        wide = np.hstack([np.ones((len(votes), 1)), votes])
        for y, p in enumerate((1 - share, share)):
            out[y] = (wide * (p * n)[:, None]).T @ wide
        return out

    def fit(self, moments: np.ndarray) -> None:
        self.rates = (moments[:, 0, 1:] + 0.5) / (moments[:, :1, 0] + 1)
        self.rates = np.clip(self.rates, 1e-6, 1 - 1e-6)

    def correlate(self, moments: np.ndarray) -> None:
        """Correlations within the classes, beyond chance."""
        corr = np.zeros((self.m, self.m))
        for y in (0, 1):
            n = moments[y, 0, 0]
            if n < 1:
                continue
            p = moments[y, 0, 1:] / n
            sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
            r = (moments[y, 1:, 1:] / n - np.outer(p, p)) / np.outer(sd, sd)
            corr = np.maximum(corr, np.where((np.outer(p, p) > 0) & (r > CHANCE), r, 0))
        np.fill_diagonal(corr, 0)
        self.corr = corr


def label_model(votes: DataFrame, train_votes: DataFrame, m: int) -> LabelModel:
    """Fit to all rows' ``votes`` and the training rows' (votes, toxic)."""
    model = LabelModel(m)
    counted = cut(votes.groupBy("votes").agg(F.count("*").alias("n")))
    known = cut(train_votes.groupBy("votes", "toxic").agg(F.count("*").alias("n")))

    def sums(rows: DataFrame, share) -> np.ndarray:
        def of_batch(batch):
            v = unpacked(batch.column("votes").to_numpy(), m)
            return model.moments(v, share(batch, v), batch.column("n").to_numpy().astype(float))

        return _summed(rows, (2, m + 1, m + 1), of_batch, *rows.columns)

    labelled = sums(known, lambda batch, v: batch.column("toxic").to_numpy().astype(float))
    silent = known.filter(F.expr(f"votes & {(1 << m - PATTERNS) - 1}L = 0")).groupBy("toxic").agg(F.sum("n")).collect()
    silent = {0: 0, 1: 0} | {r[0]: r[1] for r in silent}
    model.silent = float(np.log((silent[1] + 0.5) / (silent[0] + 0.5)))
    model.prior = float(np.log((labelled[1, 0, 0] + 0.5) / (labelled[0, 0, 0] + 0.5)))
    model.fit(labelled)
    for _ in range(EM_STEPS):
        found = sums(counted, lambda batch, v: model.posterior(v))
        found *= UNLABELLED * labelled[:, 0, 0].sum() / max(found[:, 0, 0].sum(), 1)
        moments = labelled + found
        model.fit(moments)
        model.correlate(moments)
    return model


def logistic(rows: list[np.ndarray], dense: np.ndarray, target: np.ndarray, size: int) -> np.ndarray:
    """Weights (words, patterns, intercept) of a logistic regression with soft targets."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    n, d = len(rows), dense.shape[1]
    w, mean, square = np.zeros(size + d + 1), np.zeros(size + d + 1), np.zeros(size + d + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(at, w[col], n) + dense @ w[size : size + d] + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
        grad = np.concatenate([np.bincount(col, err[at], size), err @ dense, [err.sum()]])
        grad[:-1] += L2 * w[:-1] * 0.1
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        w -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


def classifier(docs: DataFrame, words: list[str], model: LabelModel, total: int) -> tuple[dict[str, float], np.ndarray]:
    """Weights of words, and of the patterns with the intercept last, trained on the posterior
    labels of the ``SAMPLE`` rows whose ids hash lowest."""
    m = len(words) + PATTERNS
    sample = _lowest(docs.filter(~held_out()), SAMPLE, total).select("text")

    def fit(batches):
        texts = [t or "" for b in batches for t in b.column("text").to_pylist()]
        found = [tokens(t) for t in texts]
        target = model.posterior(unpacked(voted(texts, words), m)) if texts else np.zeros(0)
        own = [cues(f) for f in found]
        seen, toxic = Counter(), Counter()
        for c, p in zip(own, target, strict=True):
            seen.update(c)
            if p >= 0.5:
                toxic.update(c)
        common = sorted(c for c, n in seen.items() if n >= LEAST_ROWS)
        size = (float((target >= 0.5).sum()), float((target < 0.5).sum()))
        z = speaking(np.array([toxic[c] for c in common], float), np.array([seen[c] - toxic[c] for c in common], float), size)
        number = {common[k]: i for i, k in enumerate(np.argsort(-np.abs(z), kind="stable")[:VOCABULARY])}
        rows = [np.array(sorted(number[c] for c in number.keys() & f), np.int64) for f in own]
        dense = np.array([patterns(t, f) for t, f in zip(texts, found, strict=True)]).reshape(len(texts), PATTERNS)
        w = logistic(rows, dense, target, len(number)) if texts else np.zeros(PATTERNS + 1)
        names = [*number, *[None] * (PATTERNS + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(w)], names=["word", "weight"])

    rows = sample.coalesce(1).mapInArrow(fit, "word string, weight double").collect()  # at most VOCABULARY rows
    return {r[0]: r[1] for r in rows if r[0] is not None}, np.array([r[1] for r in rows if r[0] is None])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    # At most LABELLED ids and labels, which every task can have; no text is moved for them.
    train = cut(docs.join(F.broadcast(_known(labels)), "doc_id").select("text", "toxic"))
    words = lexicon(train)
    m = len(words) + PATTERNS

    def votes(batch):
        return {"votes": voted([t or "" for t in batch.column("text").to_pylist()], words)}

    out = docs.withColumn("held_out", held_out())
    if not words:
        return out.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    all_votes = cut(with_columns(docs, "votes bigint", votes, "text").select("votes"))
    model = label_model(all_votes, with_columns(train, "votes bigint", votes).select("votes", "toxic"), m)
    weight, rest = classifier(docs, words, model, all_votes.count())
    worth = {w: v for w, v in weight.items() if abs(v) > 1e-3}

    def score(batch):
        z, known = [], Known(worth)
        for t in batch.column("text").to_pylist():
            found = tokens(t or "")
            own = sorted(known.among(found))
            z.append(sum(map(worth.__getitem__, own)) + float(np.dot(patterns(t or "", found), rest[:-1])) + rest[-1])
        return {"score": 1 / (1 + np.exp(-np.clip(np.array(z), -40, 40)))}

    out = with_columns(out, "score double", score).drop("text")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
