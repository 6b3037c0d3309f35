"""Alignment of two tokenizers against a plain reading of its definition."""

import collections
import hashlib

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from loomstead.llm import piece_cache, queries, token_alignment
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ALIGNER = token_alignment.Aligner(A, B)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            out[chr(extra)] = b
            extra += 1
    return out


def ends(parts):
    total, out = 0, []
    for p in parts:
        total += len(p)
        out.append(total)
    return out


def groups_of(libraries, text):
    """[(ids of a, ids of b)], or nothing where the text has no tokens."""
    tokenizer, model = libraries
    if not text:
        return []
    letters, whole = byte_letters(), f" {text}".encode()
    a = tokenizer.encode(f" {text}", add_special_tokens=False).ids
    b = model.encode(text)
    parts_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
    pieces = [model.id_to_piece(i) for i in b]
    parts_b = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
    if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
        return []
    ends_a, ends_b = ends(parts_a), ends(parts_b)
    out, i, j = [], 0, 0
    for end in sorted({*ends_a} & {*ends_b}):
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def expected(libraries, documents):
    groups = [groups_of(libraries, t) for _, t in documents]
    total = collections.Counter((a[-1], b[-1]) for g in groups for a, b in g)
    most = collections.Counter()
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    rows = []
    for (i, _), g in zip(documents, groups, strict=True):
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append(
            (i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
             sum(total[x] == most[x[1]] for x in links), sum(total[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if g else "")
        )
    return sorted(rows, key=str)


def test_the_query_over_its_whole_table(spark, libraries):
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet")
    found = queries.QUERIES["op13_token_alignment"](spark, FOLDER)
    assert found.columns == COLUMNS
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(libraries, list(zip(documents.doc_id, documents.text, strict=True)))


TEXTS = [
    (1, "the same words, the same words"), (1, "the same words, the same words"), (2, None), (3, ""), (None, "no id"), (4, " "),
    (5, "a▁b is not given back"), (6, "<|endoftext|> <s> <0x41>"), (7, "\x00\n\n\t  x  \r\n"), (8, "ﬁ é é 日本語 🙂🙂"),
    (9, "x" * 3000 + " " + "ab " * 2000), (10, "a　b c  d"),
]


@pytest.mark.parametrize("broadcast", [token_alignment.BROADCAST, 0])
def test_odd_rows_by_broadcast_and_by_join(spark, libraries, broadcast):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 AS a", "'x' AS b", "2 AS _at", "3 AS times", "4 AS pair")
    found = token_alignment.alignments(docs, A, B, broadcast)
    assert [x for x in zip(sorted((tuple(r) for r in found.collect()), key=str), expected(libraries, TEXTS)) if x[0] != x[1]] == []
    assert token_alignment.alignments(docs.filter("doc_id < 0"), A, B, broadcast).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sS1 .,\n\t<|>éßΣ0x") + [chr(c) for c in (0x85, 0xA0, 0x301, 0x2003, 0x2581, 0x4E2D, 0x1F600)]), max_size=50))
def test_any_text(libraries, text):
    found, groups = ALIGNER.of([text])[0], groups_of(libraries, text)
    if not groups:
        assert found is None
    else:
        plain = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert found[2] == len(groups) and found[4] == hashlib.sha256(plain.encode()).hexdigest()


def test_windows_are_remembered_within_bounds(libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "WINDOWS", 3)
    aligner = token_alignment.Aligner(A, B)
    for text in ("one two three four five six", "seven eight nine", "one two three four five six"):
        assert aligner.of([text, None, text])[2][2] == len(groups_of(libraries, text))
    assert 0 < len(aligner.known) <= 9


def test_pieces_met_again_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(piece_cache, "CACHED", 200)
    monkeypatch.setattr(piece_cache, "TOGETHER", 1)
    pieces = piece_cache.id_bytes(public_tokenizers.path("word_bpe_49k.json"))
    word, learnt = pieces._word, []
    pieces._word = lambda w: learnt.append(w) or word(w)
    texts = ["the hot words " + " ".join("".join(chr(97 + (k * 40 + j) // 26**i % 26) for i in range(4)) for j in range(40)) for k in range(30)]
    assert [b"".join(x) for x in pieces.each(texts)] == [pieces.whole(t) for t in texts]
    assert learnt.count("hot") == 1 and len(pieces.seen) + len(pieces.before) <= 300


def test_a_window_is_encoded_once_whatever_stands_around(libraries):
    aligner, given = token_alignment.Aligner(A, B), []
    whole = aligner.whole
    aligner.whole = lambda texts: given.extend(texts) or whole(texts)
    texts = ["some words. here", "here  are\n \nsome words.", " words. a", "a▁b some", "x\t y \n z  "] * 2
    for text, found in zip(texts, aligner.of(texts), strict=True):
        groups = groups_of(libraries, text)
        plain = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert (found and found[4]) == (hashlib.sha256(plain.encode()).hexdigest() if groups else None)
    assert given.count("some") == given.count("words.") == 1 and "some words. here" not in given


_WORDS = piece_cache.id_bytes(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abÀé×÷ÃßS'.,1 \n\t\x00\x1c\xa0µ̈語😀", max_size=40), max_size=6))
def test_ids_of_pieces_on_arrays_equal_the_library(texts):
    own, extra = _WORDS, ["abcdefghijklmnopqrstuvwxyz, " * 2, "x <|endoftext|> y"]
    whole = [own.whole(t) for t in texts + extra]
    assert list(own.ids([t.encode() for t in texts + extra])) == whole


def test_only_distinct_pieces_become_python_objects(monkeypatch):
    """A gigabyte of text has some 200 million pieces; looking each up took op7 431 CPU seconds of it."""
    own = piece_cache.id_bytes(public_tokenizers.path("word_bpe_49k.json"))
    asked = []
    kept = own._kept
    monkeypatch.setattr(own, "_kept", lambda pieces, distinct: asked.extend(pieces) or kept(pieces, distinct))
    assert list(own.ids([b"ein Wort, ein Wort " * 500] * 20)) == [own.whole("ein Wort, ein Wort " * 500)] * 20
    assert sorted(asked) == [",", "Wort", "ein"]
