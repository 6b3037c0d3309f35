"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Each text gives a vector of transformed statistics: log of the mean word length, and the
square roots of the shares of symbols among word characters, of repeated lines among lines
and of words in repeated windows. For each language and source the centre and covariance of
the tightest ``SHARE`` of the vectors are estimated (the MCD estimate), and a text whose
Mahalanobis distance from them is too large is rejected.

The estimate runs over all rows. A concentration step is one aggregate: rows are folded per
group and distance bin into counts and sums of products, and the bins that hold the nearest
``SHARE`` of a group give its next centre and covariance. Rows meet the estimates without being
moved: those of up to ``BROADCAST_ROWS`` groups are broadcast after a count; more are joined
between exchanges of the join's own, where a hot group is split, and folded before the next
exchange. A hot group thus never meets in a task. Groups below ``LEAST`` rows are pooled by language, then all together; a pool that is
still too small to estimate rejects nothing.

Nulls: a null text is empty; null languages and sources are groups of their own. Texts that
fail the base rules take no part in the estimate. Repeated rows count each time.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.common import IS_SPACE, cut, null_safe_key, texts_of, with_columns
from loomstead.session import join_per_key

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
LEAST = 100
SHARE = 0.75
STEPS = 8
#: Distances are binned by sixteenths of a power of two.
BINS = 16
#: Squared distances below this share a bin: they are the centre, always within the nearest.
NEAREST = 0.05
#: Chi-square tail of a distance that rejects, with four degrees of freedom.
TAIL = 1e-5
#: Variances are raised by the squares of these. The shares are mostly zero in clean text, and
#: one repeated header line in a short text is not junk.
FLOOR = (0.06, 0.05, 0.25, 0.15)
#: So many rows of a model or of a list of groups (about 200 bytes each) are broadcast.
BROADCAST_ROWS = 20_000
P = 4
X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, x0 double, x1 double, x2 double, x3 double"
)


def chi2_below(x: float) -> float:
    """P(chi-square with four degrees of freedom <= x)."""
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def chi2_quantile(p: float) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid) < p else (low, mid)
    return low


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal rows is to be multiplied by."""
    if share >= 1:
        return 1.0
    t = chi2_quantile(share) / 2
    return share / (1 - math.exp(-t) * (1 + t + t * t / 2))


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words within windows of ``width`` words that occur twice or more in the text."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    keys, size = ids[: n - width + 1], len(number)
    for k in range(1, width):
        if size * len(number) >= 1 << 62:
            _, keys = np.unique(keys, return_inverse=True)
            size = n
        keys, size = keys * len(number) + ids[k : n - width + 1 + k], size * len(number)
    _, at, found = np.unique(keys, return_inverse=True, return_counts=True)
    twice = found[at] > 1
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= twice
    return int(covered.sum())


def measures(batch: pa.RecordBatch) -> dict:
    texts = texts_of(batch)
    rows = np.zeros((len(texts), 6), np.int64)
    symbol, blank = np.zeros(256, bool), IS_SPACE
    symbol[list(SYMBOLS)] = True
    for k, text in enumerate(texts):
        words = text.split()
        data = np.frombuffer(text, np.uint8)
        lines = [x for x in text.split(b"\n") if x.split(None, 1)]
        rows[k] = (
            len(words),
            int(((data & 0xC0) != 0x80).sum() - blank[data].sum()),
            int(symbol[data].sum()),
            len(lines) - len(set(lines)),
            repeated_window_words(words),
            len(lines),
        )
    n, chars, symbols, dup, repeat, lines = rows.T
    some = np.maximum(n, 1)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat,
        "base_failed": (n < LEAST_WORDS) | (100 * repeat > 50 * n),
        "x0": np.log(np.maximum(chars, 1) / some), "x1": np.sqrt(symbols / np.maximum(chars, 1)),
        "x2": np.sqrt(dup / np.maximum(lines, 1)), "x3": np.sqrt(repeat / some),
    }


def _key(level: int):
    return (
        null_safe_key("lang", "source"),
        F.concat(F.lit("lang "), null_safe_key("lang")),
        F.lit("all"),
    )[level]


def pools(passed: DataFrame) -> DataFrame:
    """For each language and source the pool it is estimated in: itself, its language's
    small groups, or all small ones. One row per language and source."""
    found = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    found = cut(found.withColumn("pool", F.when(F.col("n") >= LEAST, _key(0)).otherwise(_key(1))))
    by_pool = found.groupBy("pool").agg(F.sum("n").alias("pool_n"))
    found = found.join(by_pool, "pool")
    return found.select(
        null_safe_key("lang", "source").alias("cell"),
        F.when(F.col("pool_n") >= LEAST, F.col("pool")).otherwise(_key(2)).alias("pool"),
    )


def _with_groups(rows: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows joined to a written frame of a row or two for each group. No task gets a whole group:
    either nothing of ``rows`` is moved, or the adaptive join splits a hot group, and what is
    aggregated after it can't reuse its partitioning."""
    if few.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(few), key, how)
    return join_per_key(rows, few, [key], how)


def _distance(x: list, m: list, q: dict):
    d = [x[i] - m[i] for i in range(P)]
    return sum((1 if i == j else 2) * d[i] * d[j] * q[i, j] for i, j in PAIRS)


MODEL = "pool string, start int, n bigint, log_det double, " + ", ".join(
    [f"m{i} double" for i in range(P)] + [f"q{i}{j} double" for i, j in PAIRS]
)


def _model(frame: pd.DataFrame, share: pd.Series) -> pd.DataFrame:
    """Centres, inverse covariances and determinants of rows of moments."""
    rows = []
    for r, part in zip(frame.to_dict("records"), share, strict=True):
        n = max(r["n"], 1)
        m = np.array([r[f"s{i}"] / n for i in range(P)])
        c = np.zeros((P, P))
        for i, j in PAIRS:
            c[i, j] = c[j, i] = r[f"s{i}{j}"] / n - m[i] * m[j]
        c = c * consistency(min(max(part, 0.05), 1.0)) + np.diag(np.square(FLOOR))
        c, m = np.round(c, 10), np.round(m, 10)
        q = np.linalg.inv(c)
        rows.append(
            {"pool": r["pool"], "start": r["start"], "n": r["n"], "log_det": round(float(np.linalg.slogdet(c)[1]), 9)}
            | {f"m{i}": m[i] for i in range(P)} | {f"q{i}{j}": q[i, j] for i, j in PAIRS}
        )
    return pd.DataFrame(rows, columns=[x.split()[0] for x in MODEL.split(", ")])


def _moments():
    return [
        F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
        *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}{j}") for i, j in PAIRS],
    ]


def _scored(rows: DataFrame, model: DataFrame) -> DataFrame:
    q = {(i, j): F.col(f"q{i}{j}") for i, j in PAIRS}
    d2 = _distance([F.col(x) for x in X], [F.col(f"m{i}") for i in range(P)], q)
    return _with_groups(rows, model, "pool").withColumn("d2", F.greatest(d2, F.lit(NEAREST)))


def _starts(rows: DataFrame) -> DataFrame:
    """Two starts for each pool: all of its rows, and its medians with floor variances."""
    middle = [F.round(F.percentile_approx(x, 0.5, 1000), 2).alias(f"t{i}") for i, x in enumerate(X)]
    sums = rows.groupBy("pool").agg(*_moments(), *middle)

    def run(frames):
        for f in frames:
            yield _model(f.assign(start=0), pd.Series(1.0, f.index))
            f = f.assign(start=1)
            for i in range(P):
                f[f"s{i}"] = f[f"t{i}"] * f["n"]
            for i, j in PAIRS:
                spread = 9 * FLOOR[i] ** 2 if i == j else 0
                f[f"s{i}{j}"] = (f[f"t{i}"] * f[f"t{j}"] + spread) * f["n"]
            yield _model(f, pd.Series(1.0, f.index))

    return cut(sums.mapInPandas(run, MODEL))


def _concentrated(rows: DataFrame, model: DataFrame) -> DataFrame:
    """One concentration step: moments of the nearest ``SHARE`` of each pool's rows."""
    near = _scored(rows, model.drop("n"))
    bins = near.groupBy("pool", "start", F.floor(F.log2("d2") * BINS).cast("int").alias("bin")).agg(*_moments())

    def run(key, frame):
        frame = frame.sort_values("bin")
        upto = frame["n"].cumsum()
        total = int(upto.iloc[-1])
        kept = frame[(upto - frame["n"]) < SHARE * total]
        sums = kept.drop(columns="bin").sum(numeric_only=True).to_frame().T
        sums = sums.assign(pool=key[0], start=key[1])
        out = _model(sums, sums["n"] / total)
        return out.assign(n=total)

    return cut(bins.groupBy("pool", "start").applyInPandas(run, MODEL))


def mcd(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """The MCD estimate of each ``pool`` of rows with x0..x3: per pool the result with the
    smallest determinant after ``steps`` concentration steps from two fixed starts."""
    model = _starts(rows)
    for _ in range(steps):
        model = _concentrated(rows, model)
    best = model.groupBy("pool").agg(F.min(F.struct("log_det", "start")).alias("_best"))
    return cut(
        model.join(best, "pool").filter("start = _best.start").drop("_best", "start", "log_det").filter(F.col("n") >= LEAST)
    )


def fitted(slim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pools of languages and sources, and the model of each pool, from measured rows."""
    passed = slim.filter(~F.col("base_failed"))
    where = cut(pools(passed))
    pooled = _with_groups(passed.withColumn("cell", null_safe_key("lang", "source")), where, "cell").select("pool", *X)
    return where, mcd(cut(pooled))


def judged(measured: DataFrame, where: DataFrame, model: DataFrame, tail: float = TAIL) -> DataFrame:
    """Add ``distance`` (null without a model) and ``kept`` to measured rows."""
    names = measured.columns
    rows = _with_groups(measured.withColumn("cell", null_safe_key("lang", "source")), where, "cell", "left")
    q = {(i, j): F.col(f"q{i}{j}") for i, j in PAIRS}
    d2 = _distance([F.col(x) for x in X], [F.col(f"m{i}") for i in range(P)], q)
    far = chi2_quantile(1 - tail)
    return _with_groups(rows, model.drop("n"), "pool", "left").select(
        *names, F.sqrt(F.greatest(d2, F.lit(0.0))).alias("distance"),
        (~F.col("base_failed") & F.coalesce(d2 <= far, F.lit(True))).alias("kept"),
    )


def quality(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """One row per document: its measures, distance and verdict. An empty table gives none."""
    slim = cut(with_columns(docs, MEASURES, measures, "doc_id", "lang", "source", "text").drop("text"))
    return judged(slim, *fitted(slim), tail).drop(*X)


def filtered(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """The documents that are kept, with all of their columns. Every row is judged by its own
    text, so repeated ids do no harm."""
    slim = cut(with_columns(docs, MEASURES, measures, "lang", "source", "text").drop("text"))
    where, model = fitted(slim)
    whole = docs.select("lang", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    verdict = judged(with_columns(whole, MEASURES, measures), where, model, tail)
    return verdict.filter("kept").select("_row.*")
