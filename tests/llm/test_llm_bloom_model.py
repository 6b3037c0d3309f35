"""Scores of the Bloom-filter language model against exact counts in plain Python."""

import collections
import math
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from loomstead.llm import bloom_language_model as model
from loomstead.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def lower_end(count):
    return max([x for x in model.LEVELS.tolist() if x <= count], default=0)


def expected(documents, order):
    """Per document all columns; the score once as with exact membership."""
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in documents]
    grams = [collections.Counter() for _ in range(order + 1)]
    for (_, text), out in zip(documents, held, strict=True):
        if not out:
            marked = ["start", *tokens_of(text)]
            for n in range(1, order + 1):
                grams[n].update(tuple(marked[k : k + n]) for k in range(len(marked) - n + 1))
    starts = grams[1][("start",)]
    total, distinct = sum(grams[1].values()) - starts, len(grams[1]) - (starts > 0)
    rows = []
    for (i, text), out in zip(documents, held, strict=True):
        marked = ["start", *tokens_of(text)]
        base = score = known = 0
        for k in range(1, len(marked)):
            count = grams[1][(marked[k],)]
            known += count > 0
            p = (count + 1) / (total + distinct + 1)
            base += math.log10(p)
            for n in range(2, min(order, k + 1) + 1):
                context = grams[n - 1][tuple(marked[k - n + 1 : k])]
                context = context if n == 2 else lower_end(context)
                own = min(lower_end(grams[n][tuple(marked[k - n + 1 : k + 1])]), context, count)
                p, count = (own + model.PRIOR * p) / (context + model.PRIOR), own
            score += math.log10(p)
        rows.append((i, out, len(marked) - 1, known, total, base, score))
    return pd.DataFrame(rows, columns=COLUMNS)


def compared(found, wanted, share):
    """Everything but the score is exact; a false positive can move a score a little."""
    keys = ["doc_id", "n_tokens", "score"]
    found, wanted = found.sort_values(keys).reset_index(drop=True), wanted.sort_values(keys).reset_index(drop=True)
    for c in COLUMNS[:5]:
        assert found[c].tolist() == wanted[c].tolist() or found[c].isna().equals(wanted[c].isna())
    assert np.allclose(found.base_score, wanted.base_score, rtol=1e-9)
    apart = (found.score - wanted.score).abs() / found.n_tokens
    assert apart.mean() < share and apart.max() < 20 * share


def test_the_query_over_its_whole_table(spark):
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet")
    found = queries.QUERIES["op12_bloom_language_model"](spark, FOLDER).toPandas()
    assert list(found.columns) == COLUMNS
    compared(found, expected(list(zip(documents.doc_id, documents.text, strict=True)), 2), 0.003)
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum()


TEXTS = [
    (1, "A b c a b C"), (1, "A b c a b C"), (2, None), (3, ""), (None, "a b"), (4, " \t\n"), (5, "é É a b"),
    (6, "start end"), (7, "w " * 5000), (8, " ".join(map(str, range(4000)))), (18, "a b c"), (20, "x y z"),
]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_odd_rows_by_broadcast_and_by_blocks(spark, order):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS block", "2 AS _at", "false AS held_out", "3 AS segment")
    sent = model.scored(docs, order=order).toPandas()
    compared(sent, expected(TEXTS, order), 0.02)
    blocks = model.scored(docs, order=order, broadcast=0).toPandas()
    key = ["doc_id", "n_tokens"]
    pd.testing.assert_frame_equal(sent.sort_values(key).reset_index(drop=True), blocks.sort_values(key).reset_index(drop=True))
    assert model.scored(docs.filter("doc_id < 0"), order=order).collect() == []
    assert model.scored(docs.filter("doc_id < 0"), order=order, broadcast=0).collect() == []


def test_many_segments_and_blocks_give_the_same(spark, monkeypatch):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    one = model.scored(documents).toPandas().sort_values("doc_id").reset_index(drop=True)
    monkeypatch.setattr(model, "SEGMENT_BYTES", 20_000)
    monkeypatch.setattr(model, "BLOCK_BYTES", 50_000)
    some = model.scored(documents).toPandas().sort_values("doc_id").reset_index(drop=True)
    blocks = model.scored(documents, broadcast=0).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(some, blocks)
    assert one[COLUMNS[:6]].round(6).equals(some[COLUMNS[:6]].round(6))
    assert ((one.score - some.score).abs() / one.n_tokens).mean() < 0.003


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 10**9), min_size=1, max_size=60))
def test_a_piece_gives_back_every_level(counts):
    grams, n = np.array(list(counts), np.uint64), np.array(list(counts.values()), np.int64)
    read = model.probed(model.filter_piece(grams, n), grams)
    lower = model.LEVELS[model.level_of(n) - 1]
    assert (read >= lower).all() and (read == lower).mean() > 0.8
    by = np.argsort(grams)
    assert (model.looked_up(model.exact_piece(grams[by], n[by]), grams) == n).all()


def test_false_positives_are_rare():
    rng = np.random.default_rng(5)
    grams = rng.integers(0, 2**64, 300_000, dtype=np.uint64)
    piece = model.filter_piece(grams[:200_000], np.ones(200_000, np.int64))
    assert (model.probed(piece, grams[:200_000]) >= 1).all()
    assert (model.probed(piece, grams[200_000:]) > 0).mean() < 0.015
