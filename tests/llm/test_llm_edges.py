"""Every operator and stage on odd rows, and on a table without rows."""

import corpus_pipeline
import public_tokenizers
import pytest
from loomstead.llm import (
    common,
    exact_packing,
    license_bands,
    nn_descent,
    overlap_tokens,
    paragraph_bands,
    piece_cache,
    quota_mix,
    robust_outliers,
    simhash_trees,
    warc_store,
    weak_toxicity,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_words long, kept boolean, size string, target string, score string, piece string, fp string, _copy string"
)
LONG = " ".join(f"w{k}é" for k in range(9000)) + " " + "x" * 3000
TEXTS = [
    (1, "one two three four five.", "en", "a"), (1, "one two three four five.", "en", "a"), (2, None, "en", None),
    (None, "no id at all", None, "a"), (3, "", None, None), (4, " \n\t ", "en", "b"), (5, LONG, "en", "a"),
    (6, LONG + " end", "fr", "c"), (7, "Released under the MIT License. <|endoftext|>", "en", "a"), (8, LONG, "en", "b"),
]
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))

PER_DOCUMENT = {
    "quality": robust_outliers.quality,
    "tokens": lambda d: overlap_tokens.token_counts(d, BYTE),
    "mix": quota_mix.takings,
    "simhash": simhash_trees.near_duplicates,
    "toxicity": lambda d: weak_toxicity.scored(d, d.selectExpr("doc_id", "0 AS quality", "CAST(doc_id % 2 AS INT) AS toxic")),
}
OTHERS = {
    "passages": paragraph_bands.repeated_passages,
    "packing": lambda d: exact_packing.packed(d, WORD),
    "licenses": license_bands.licenses,
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, source, len(t or ""), -1, None, "s", "t", "c", "p", "f", "y") for i, t, lang, source in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(odd, name):
    found = PER_DOCUMENT[name](odd).collect()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found)
    assert ids == sorted((t[0] is None, t[0] or 0) for t in TEXTS)


@pytest.mark.parametrize("name", PER_DOCUMENT | OTHERS)
def test_no_rows(odd, name):
    assert (PER_DOCUMENT | OTHERS)[name](odd.filter("doc_id < 0")).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, odd, name, stage):
    for docs in (odd, odd.filter("doc_id < 0")):
        out = stage(spark, docs, "")
        assert out.schema.simpleString() == docs.schema.simpleString()
        rows = out.collect()
        given = {(r["doc_id"], r["source"]) for r in docs.collect()}
        assert {(r["doc_id"], r["source"]) for r in rows} <= given


def test_stage_results(spark, odd):
    stages = dict(corpus_pipeline.STAGES)
    assert [r["doc_id"] for r in stages["quality"](spark, odd, "").orderBy("doc_id").collect()] == [5, 6, 8]
    kept = [r["doc_id"] for r in stages["near_dedup"](spark, odd, "").collect()]
    assert kept.count(1) == 1 and 8 not in kept and 6 not in kept and 5 in kept
    empty = [r for r in stages["near_dedup"](spark, odd, "").collect() if not (r["text"] or "").strip()]
    assert [r["doc_id"] for r in empty] == [2]  # texts without words have one fingerprint
    cleaned = {r["doc_id"]: r["text"] for r in stages["substring_dedup"](spark, odd, "").collect()}
    assert not cleaned.keys() & {6, 8} and cleaned[5] == LONG and cleaned[2] is None and cleaned[3] == ""


def test_last_stage(spark, odd):
    pack = corpus_pipeline.STAGES[-1][1]
    assert pack(spark, odd, "").filter("doc_id = 1").count() == 2
    assert pack(spark, odd.filter("doc_id < 0"), "").collect() == []


def test_odd_passages_and_licenses(odd):
    found = {r["doc_id"]: r["kept_doc_ids"] for r in paragraph_bands.repeated_passages(odd).collect()}
    assert found.keys() == {6, 8} and all(5 in k for k in found.values())
    assert [(r["doc_id"], r["license"]) for r in license_bands.licenses(odd).collect()] == [(7, "MIT")]


def test_odd_pages(spark):
    rows = [(1, "u", "<a>"), (2, None, "<a>"), (2, None, "<a>"), (3, "u\nv", None), (4, "w", ""), (None, "x", "<a>"), (5, "y", "é\r\n\r\n" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS address")
    found = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc_store.archived(pages).collect()}
    assert found == {
        (1, "response", None, 3), (2, "revisit", 1, 3), (3, "response", None, 0), (4, "revisit", 3, 0), (None, "revisit", 1, 3),
        (5, "response", None, 12000),
    }
    assert warc_store.archived(pages.filter("page_id < 0")).collect() == []


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]),
        (7, [1.0]), (None, [1.0, 1.0]), (8, [-3.0, 0.0]), (20, [2.0, 0.0]), (20, [0.0, 2.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "0 AS node", "0 AS rank")
    got = [tuple(r) for r in nn_descent.nearest(vectors, "vec_id % 20 = 0").orderBy("query_id", "rank").collect()]
    assert [g for g in got if g[0] == 0] == [(0, 1, 20, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 0.5), (0, 4, 20, 0.0), (0, 5, 8, -3.0)]
    assert nn_descent.nearest(vectors.filter("vec_id < 0"), "vec_id % 20 = 0").collect() == []


def test_tasks_hand_back_memory(monkeypatch):
    """Also a task that fails, or whose rows are not all wanted."""
    calls = []
    monkeypatch.setattr(common, "hand_back", lambda: calls.append(1))
    assert list(common.tidy(lambda batches: (2 * x for x in batches))([1, 2])) == [2, 4] and len(calls) == 1
    some = common.tidy(iter)([1, 2])
    assert next(some) == 1 and len(calls) == 1
    some.close()
    assert len(calls) == 2
    with pytest.raises(ZeroDivisionError):
        list(common.tidy(lambda batches: (1 // x for x in batches))([0]))
    assert len(calls) == 3
    monkeypatch.undo()
    common.hand_back()


def test_packing_keeps_a_third_of_the_pieces(monkeypatch):
    monkeypatch.setattr(piece_cache, "CACHED", 600)
    monkeypatch.setattr(piece_cache, "TOGETHER", 1)
    pieces = piece_cache.id_bytes(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join("".join(chr(97 + (k * 40 + j) // 26**i % 26) for i in range(4)) for j in range(40)).encode() for k in range(30)]
    most = 0
    for text, ids in zip(texts, pieces.ids(texts), strict=True):
        assert ids == pieces.whole(text.decode())
        most = max(most, len(pieces.seen) + len(pieces.before))
    assert most <= 300
