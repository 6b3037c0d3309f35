"""Cues and capitals, all of them."""

import numpy as np
from loomstead.llm import weak_toxicity


def test_a_rarer_cue_is_scored_among_many_common_ones(spark):
    rng = np.random.default_rng(3)
    common = " ".join("".join(w) for w in rng.choice(list("abcdefghijklmnopqrs"), (21_000, 9)))
    rows = [(common + (" zyzzyva" if toxic and k % 5 < 3 else ""), toxic) for toxic in (0, 1) for k in range(40)]
    assert weak_toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int")) == ["zyzzyva"]


def test_capitals_of_long_texts_are_all_counted():
    text = "aB cD eF " * 4000
    assert weak_toxicity.patterns(text, text.split())[0] == 2 * sum(map(str.isupper, text)) / len(text)
    text = "aB" * 8192  # every fourth letter, and more, is small
    assert weak_toxicity.patterns(text, [text])[0] == 1.0
