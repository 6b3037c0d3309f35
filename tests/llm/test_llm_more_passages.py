"""Passages that sentences and lines alone don't show."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
from loomstead.llm import paragraph_bands

SCHEMA = "doc_id long, text string"


def words_of(rng, n):
    return ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(n)]


def wrapped(words, width):
    return "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))


def hidden(rng, passages):
    """A document of its own words around each passage."""
    return [(k, "\n".join([wrapped(words_of(rng, 70), 9), p, wrapped(words_of(rng, 70), 9)])) for k, p in enumerate(passages)]


def test_passages_of_short_lines_wrapped_otherwise(spark):
    rng = np.random.default_rng(7)
    passages = [words_of(rng, n) for n in (50, 50, 50, 54, 60, 200) * 3]
    rows = hidden(rng, [wrapped(p, 5) for p in passages] + [wrapped(p, (5, 7, 40)[k % 3]) for k, p in enumerate(passages)])
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {(r["doc_id"], r["first_word"], r["n_words"], *r["kept_doc_ids"]) for r in paragraph_bands.repeated_passages(docs).collect()}
    assert found == {(len(passages) + k, 70, len(p), k) for k, p in enumerate(passages)}


def test_a_text_that_repeats_itself_stays(spark):
    docs = spark.createDataFrame([(0, "ha " * 100), (1, "ha " * 100)], SCHEMA)
    assert {r["doc_id"] for r in paragraph_bands.repeated_passages(docs).collect()} <= {1}


def test_every_25_words_hold_a_window():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    _, place = paragraph_bands.windows(words, np.array([1500, 0, 3, 2497]))
    for base, end in ((0, 1500), (1503, 4000)):
        own = place[(place >= base) & (place < end)]
        for a in range(base, end - 24):
            assert ((own >= a) & (own + paragraph_bands.WINDOW <= a + 25)).any()


def test_bands_meet_at_the_threshold():
    rng = np.random.default_rng(9)
    pairs, both, own = 4000, 16, 2  # 16 of 20 shingles in common: similarity 0.8
    keys = []
    common = rng.integers(0, 1 << 63, (pairs, both), dtype=np.uint64)
    for _ in range(2):
        shingles = np.hstack([common, rng.integers(0, 1 << 63, (pairs, own), dtype=np.uint64)]).ravel()
        size = np.full(pairs, both + own + paragraph_bands.SHINGLE - 1)
        keys.append(paragraph_bands.bands(shingles, np.arange(pairs) * (both + own), size))
    met = np.any([a == b for a, b in zip(*keys, strict=True)], axis=0)
    assert met.mean() >= 0.998
    print("missed", (~met).sum())


def sentences(words, size=18):
    return " ".join(" ".join(words[k : k + size]) + "." for k in range(0, len(words), size))


def test_near_copies_of_passages(spark):
    rng = np.random.default_rng(10)
    kept, copies, sizes = [], [], []
    for k in range(120):
        words = words_of(rng, 54)
        kept.append(sentences(words))
        changed = list(words)
        if k % 3 == 0:
            changed[27] = "changed"
        elif k % 3 == 1:
            changed.insert(26, "new")
        else:
            changed[27:28] = []
        if k % 2:  # no stops at all
            kept[-1] = " ".join(words)
            copies.append(" ".join(changed))
        else:
            ends = {17, 35, 53}
            at = {w: i for i, w in enumerate(words)}
            copies.append(" ".join(w + "." * (at.get(w) in ends) for w in changed))
        sizes.append(len(changed))
    rows = hidden(rng, kept + copies)
    found = {(r["doc_id"], r["first_word"], r["n_words"], *r["kept_doc_ids"]) for r in paragraph_bands.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {(120 + k, 70, n, k) for k, n in enumerate(sizes)}


def test_unlike_wholes_stay(spark):
    rng = np.random.default_rng(11)
    a, b = words_of(rng, 25), words_of(rng, 25)
    rows = hidden(rng, [" ".join([*a, *words_of(rng, 17), *b]) for _ in range(2)])  # similarity 0.5
    assert paragraph_bands.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_columns_of_any_name_stay(spark):
    """Columns named as those of the operator, or with a dot, leave it with their values."""
    rng = np.random.default_rng(11)
    passage, own = " ".join(words_of(rng, 60)), [" ".join(words_of(rng, 40)) for _ in range(2)]
    rows = [(0, f"{own[0]}\n{passage}", "a", 7, "x", "d"), (1, f"{own[1]}\n{passage}", "b", 8, None, "e"), (2, None, "c", 9, "z", "f"), (3, "", None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _spans string, _hash int, `a.b` string, _row string")
    got = {r["doc_id"]: tuple(r) for r in paragraph_bands.cleaned(docs).collect()}
    assert got == {0: rows[0], 1: (1, own[1] + "\n", *rows[1][2:]), 2: rows[2], 3: rows[3]}
    assert paragraph_bands.cleaned(docs).columns == docs.columns
    assert paragraph_bands.cleaned(docs.filter("doc_id > 5")).count() == 0


def test_memory_follows_a_slice_of_the_texts():
    batch = pa.RecordBatch.from_arrays([pa.array(["word " * 60_000, None, ""] * 40)], names=["text"])
    parts = list(paragraph_bands._slices([batch]))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert len(parts) > 8 and max(p.num_rows for p in parts) <= 15
    words = np.random.default_rng(4).integers(0, 1 << 63, 400_000, dtype=np.uint64)
    tracemalloc.start()
    paragraph_bands.windows(words, np.full(1000, 400))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * 8 * len(words)


def test_bitmaps_know_little_else(spark):
    """One bit a value let one in eight of other values pass, sixteen of which a paragraph has."""
    rng = np.random.default_rng(3)
    values = rng.integers(-(1 << 63), (1 << 63) - 1, 60_000)
    frame = spark.createDataFrame(pd.DataFrame({"value": values}))
    bitmap = paragraph_bands._bitmap(frame)
    assert paragraph_bands._is_set(bitmap, values).all()
    assert paragraph_bands._is_set(bitmap, rng.integers(-(1 << 63), (1 << 63) - 1, (4, 25_000))).mean() < 0.03


def test_stretches_equal_a_plain_fold():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(0, 12))
        first, size = sorted(rng.integers(0, 200, n).tolist()), rng.integers(8, 40, n).tolist()
        docs, plain = rng.integers(0, 4, n).tolist(), []
        for k in range(n):
            until, last = first[k] + size[k], plain[-1] if plain else None
            if last and first[k] <= last["until"] + paragraph_bands.GAP_WORDS:
                gap = first[k] - last["until"]
                last["lost"] += gap + paragraph_bands.SHINGLE - 1 if gap > 0 else 0
                if until >= last["until"]:
                    last |= {"until": until, "tail": k}
            else:
                plain.append({"first": first[k], "until": until, "head": k, "tail": k, "own": [], "lost": 0})
            plain[-1]["own"].append(k)
        want = [(x["first"], x["until"], x["head"], x["own"][-1] + 1, x["tail"], list(dict.fromkeys(docs[k] for k in x["own"])), x["lost"]) for x in plain]
        assert paragraph_bands.stretches(first, size, docs) == want


def test_band_keys_of_a_content_that_is_only_repeated_meet_nothing(spark):
    """Sixteen keys of every repeated sentence used to be counted as keys of several contents."""
    rng = np.random.default_rng(12)
    same = [" ".join(words_of(rng, 20)) + "." for _ in range(5)]
    near = words_of(rng, 30)
    texts = [" ".join(same)] * 6 + [" ".join(near) + ".", " ".join([*near[:-1], "other"]) + "."]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4, "doc_id")
    twice = paragraph_bands._twice(docs).toPandas()
    assert (twice["kind"] == 0).sum() >= 5
    met = twice.loc[twice["kind"] == 1, "value"]
    assert 0 < len(met) <= paragraph_bands.BANDS
    banded = paragraph_bands._banded(docs, paragraph_bands._bitmap(spark.createDataFrame(met.to_frame()))).toPandas()
    crowded = banded.groupby("key")["content"].nunique()
    assert (crowded == 2).sum() == len(met) and banded["content"].nunique() == 2


def test_tags_tell_contents_apart():
    rng = np.random.default_rng(13)
    keys, content = rng.integers(0, 1 << 63, (16, 1000), dtype=np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    tagged = paragraph_bands.tagged(keys, content)
    assert (paragraph_bands.counted_as(tagged) == paragraph_bands.counted_as(keys)).all()
    other = paragraph_bands.tagged(keys, content ^ np.uint64(1 << 63))
    assert (tagged != other).all() and (tagged == paragraph_bands.tagged(keys, content)).all()
    assert len(np.unique(paragraph_bands.counted_as(keys))) == keys.size


def test_pairs_are_compared_as_larger_groups_are():
    rng = np.random.default_rng(14)
    sets = []
    for _ in range(300):
        a = rng.choice(10_000, int(rng.integers(1, 40)), replace=False)
        b = np.append(a[int(rng.integers(0, 5)) :], rng.integers(10_000, 20_000, int(rng.integers(0, 4))))
        sets += [np.sort(a), np.unique(b) if len(b) else a]
    want = [paragraph_bands.similar(sets[k : k + 2])[0, 1] for k in range(0, len(sets), 2)]
    got = paragraph_bands.alike_pairs(np.concatenate(sets), np.array([len(x) for x in sets]))
    assert got.tolist() == want and 0 < sum(want) < 300


def test_stretches_of_documents_cut_by_batches(spark):
    """Documents whose rows lie in several batches are folded whole; repeated rows and null ids count once."""
    rng = np.random.default_rng(15)
    rows = []
    for k in range(40):
        doc = None if k % 10 == 3 else k // 2
        for first in sorted(rng.choice(900, int(rng.integers(1, 30)), replace=False).tolist()):
            rows += [(doc, k % 2, first, 12, int(rng.integers(0, 9)), (False, 0, 5, first, 12))] * int(rng.integers(1, 3))
    schema = "doc_id long, _text long, first int, size int, class long, kept struct<none boolean, doc_id long, _text long, first int, size int>"
    marked = spark.createDataFrame(rows, schema)
    plain = {}
    for r in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:])):
        plain.setdefault(r[:2], []).append(r)
    want = sorted(
        (str(doc), text, x[0], x[1], tuple(r[4] for r in own[x[2] : x[3]]), x[6])
        for (doc, text), own in plain.items()
        for x in paragraph_bands.stretches([r[2] for r in own], [r[3] for r in own], [0] * len(own))
    )
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("7", "1024"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = sorted((str(r["doc_id"]), r["_text"], r["first"], r["until"], tuple(r["classes"]), r["lost"]) for r in paragraph_bands._stretches(marked).collect())
            assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
