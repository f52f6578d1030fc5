"""Hashes of words and characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from dimflow.llm import jaccard, quality
from dimflow.llm.hashing import characters, text_bytes, word_hashes


def doubling(levels: int) -> str:
    """A word that differs from its complement everywhere, with equal sums of any powers modulo 2^64 once long enough."""
    word = "a"
    for _ in range(levels):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_words_that_a_sum_of_powers_confuses():
    for levels in (9, 10, 11, 13):
        word = doubling(levels)
        other = word.translate(str.maketrans("ab", "ba"))
        hashes, _ = word_hashes(pa.array([f"{word} x {other} {word}"]))
        assert hashes[0] == hashes[3] != hashes[2]


def test_long_words_link_nothing(spark):
    word = doubling(10)
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{word} b c d e"), (2, f"{other} b c d e"), (3, f"{word} B c d e")],
                                 "doc_id long, text string")
    found = {r["id"]: r["component_id"] for r in jaccard.link_classes(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


@given(st.lists(st.text(max_size=12), max_size=6))
def test_characters(texts):
    data, at = text_bytes(pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()))
    values, first = characters(data, at)
    expected = [int.from_bytes(c.encode("utf-8", "replace"), "big") for t in texts for c in t]
    assert values.tolist() == expected
    assert np.diff(first).tolist() == [len(t) for t in texts]


def test_character_grams_are_of_characters():
    """Two letters of another script make one gram of two, no grams of three or four."""
    sizes = [np.diff(first).tolist() for _, first in quality._families(pa.array(["жя", "", "ab", "日本語文"]))]
    assert sizes == [[1, 0, 1, 1], [0, 0, 0, 0], [1, 0, 1, 3], [0, 0, 0, 2], [0, 0, 0, 1]]


def test_learns_from_other_scripts():
    """Texts that differ in the order of the same letters alone; no word occurs twice."""
    rng = np.random.default_rng(7)
    letters = list("абвгдежзийклмнопрстуфхц")
    texts, good = [], []
    for _ in range(200):
        pairs = ["".join(rng.permutation(letters)[:6]) for _ in range(12)]
        good.append(bool(rng.integers(2)))
        texts.append(" ".join(p + ("щю" if good[-1] else "ющ") for p in pairs))
    weights, bias, a, b = quality.fit(pa.array(texts[:120]), np.array(good[:120]))
    odds = a * quality.logits(pa.array(texts[120:]), weights, bias) + b
    assert ((odds > 0) == np.array(good[120:])).mean() >= 0.95
