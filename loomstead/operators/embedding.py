"""Embedding jobs. An embedder has ``dim`` and ``embed(texts) -> vectors``; Spark feeds it
Arrow batches of text and nothing else of the row travels to Python."""

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine_distance
from ..schemas import DEFAULT_DIM
from ..session import join_per_key


class Embedder(Protocol):
    dim: int

    def embed(self, texts: Sequence[str]) -> Sequence[Sequence[float]]: ...


class _Slots(dict):
    """word -> slot for +1, or ``dim`` + slot for -1; filled as words turn up, but only with so many
    and with short ones, about 25 MB a worker."""

    most, longest = 100_000, 64

    def __init__(self, dim):
        self.dim = dim

    def __missing__(self, word):
        digest = hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()
        slot = int(digest[:8], 16) % self.dim + self.dim * (int(digest[8], 16) % 2)
        if len(self) < self.most and len(word) <= self.longest:
            self[word] = slot
        return slot


class HashedTextEmbedder:
    """Signed counts of hashed words, scaled to length 1. Needs no model and gives the same
    vector on every machine: word w adds +-1 to component md5(w)[:8] mod dim, the sign being
    the parity of the ninth hex digit."""

    word = re.compile(r"[^\W_]+")

    def __init__(self, dim: int = DEFAULT_DIM):
        self.dim, self._slots = dim, _Slots(dim)

    def __reduce__(self):
        return HashedTextEmbedder, (self.dim,)

    def embed(self, texts):
        counts = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            slots = [self._slots[word] for word in self.word.findall(text.lower())]
            signed = np.bincount(np.array(slots, dtype=np.int64), minlength=2 * self.dim)
            counts[row] = signed[: self.dim] - signed[self.dim :]
        lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return counts / np.where(lengths > 0, lengths, 1.0)


#: Texts that an embedder gets at a time.
EMBED_TEXTS = 1024


def embedding_of(embedder: Embedder, text: Column) -> Column:
    """The vector of each text; NULL text gives NULL without reaching the model."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            asked = texts[texts.notna()]
            for at in range(0, len(asked), EMBED_TEXTS):
                some = asked.iloc[at : at + EMBED_TEXTS]
                vectors = np.array(embedder.embed(some.tolist()), dtype=np.float32)
                vectors[~np.isfinite(vectors)] = 0.0
                out[some.index] = pd.Series(list(vectors), index=some.index, dtype=object)
            yield out

    # nondeterministic only to the optimizer, which then never copies the call into a filter
    return embed.asNondeterministic()(text)


def embed_documents(
    df: DataFrame, embedder: Embedder, document: str = "document", into: str = "embedding"
) -> DataFrame:
    """Embed every row; a missing document counts as empty text."""
    return df.withColumn(into, embedding_of(embedder, F.coalesce(F.col(document), F.lit(""))))


def embed_where_missing(df: DataFrame, embedder: Embedder, where: Column | None = None) -> DataFrame:
    """Embed rows without a vector (or those that meet ``where``), leaving the others alone."""
    needed = F.col("embedding").isNull() if where is None else where
    text = F.when(needed, F.coalesce(F.col("document"), F.lit("")))
    fresh = df.withColumn("_fresh", embedding_of(embedder, text))
    return fresh.withColumn("embedding", F.coalesce("_fresh", "embedding")).drop("_fresh")


def embed_by_content(df: DataFrame, embedder: Embedder, where: Column | None = None) -> DataFrame:
    """As :func:`embed_where_missing`, but each distinct text meets the model once.

    Texts are told apart by SHA-256 and folded before they travel; the vectors come back by a
    join in which rows that need none are dealt out evenly, and a text that very many rows share
    can be split.
    """
    needed = F.coalesce(F.col("embedding").isNull() if where is None else where, F.lit(False))
    text = F.coalesce(F.col("document"), F.lit(""))
    # no digest looks like the number that keeps the other rows apart
    content = F.when(needed, F.sha2(text, 256)).otherwise(F.xxhash64("id").cast("string"))
    rows = df.withColumns({"_content": content, "_needed": needed})
    each = rows.filter("_needed").select("_content", text.alias("_text")).distinct()
    vectors = each.select("_content", embedding_of(embedder, F.col("_text")).alias("_fresh"))
    found = join_per_key(rows, vectors, ["_content"], "left")
    return found.withColumn("embedding", F.coalesce("_fresh", "embedding")).select(df.columns)


def embedding_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """How alike two embeddings of the same ids are: one row of pairs, min, avg, max cosine."""
    pairs = left.select("id", F.col("embedding").alias("a")).join(
        right.select("id", F.col("embedding").alias("b")), "id"
    )
    cosine = pairs.select((1 - cosine_distance("a", "b")).alias("c"))
    return cosine.agg(
        F.count("c").alias("pairs"),
        F.min("c").alias("min_cosine"),
        F.avg("c").alias("avg_cosine"),
        F.max("c").alias("max_cosine"),
    )
