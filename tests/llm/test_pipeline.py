"""The pipeline's stages against plain versions, each on what the stage before it left."""

from __future__ import annotations

import brute
import public_tokenizers
import pytest
from test_against_brute import REFERENCE
from tests_llm_data import SMALL

import corpus_pipeline
from dimflow.llm import quality
from dimflow.llm.common import read_table, staged


@pytest.fixture(scope="module")
def tables(spark):
    docs = [read_table(spark, SMALL, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], SMALL), "test_stage"))
    return [[r.asDict() for r in d.collect()] for d in docs]


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights",
        "byte-level BPE encoding and decoding"]


def test_columns(tables):
    assert all(set(rows[0]) == set(tables[0][0]) for rows in tables[1:5])


def test_quality(spark, tables):
    docs = read_table(spark, SMALL, "documents")
    model = quality.train(docs, read_table(spark, SMALL, "labels"))
    verdict = {r["doc_id"]: r["kept"] for r in quality.score(docs, model).select("doc_id", "__quality.kept").collect()}
    assert sorted(r["doc_id"] for r in tables[1]) == sorted(i for i, k in verdict.items() if k)
    assert not any(quality.base_failed(*[brute.measures(r["text"])[i] for i in (0, 4)]) for r in tables[1])


def test_exact(tables):
    last = {}
    for r in sorted(tables[1], key=lambda r: r["doc_id"]):
        last[(r["text"] or "").encode().translate(brute.LOWER)] = r["doc_id"]
    assert sorted(r["doc_id"] for r in tables[2]) == sorted(last.values())


def test_near(tables):
    classes = brute.components([(r["doc_id"], r["text"]) for r in tables[2]], corpus_pipeline.NEAR_WORDS,
                               corpus_pipeline.NEAR_PERCENT)
    assert sorted(r["doc_id"] for r in tables[3]) == sorted({c for _, c in classes.values()})


def test_mix(tables):
    sizes = {}
    for r in tables[3]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words(r["text"]))
    taken = {}
    for r in tables[4]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(brute.words(r["text"]))
    largest = {s: max(len(brute.words(r["text"])) for r in tables[3] if r["source"] == s) for s in sizes}
    for source, goal in brute.targets(sizes).items():
        assert abs(taken.get(source, 0) - goal) <= largest[source]
    assert {r["doc_id"] for r in tables[4]} <= {r["doc_id"] for r in tables[3]}


def test_encode(tables):
    texts = {r["doc_id"]: r["text"] for r in tables[4]}
    assert sorted(r["doc_id"] for r in tables[5]) == sorted(r["doc_id"] for r in tables[4])
    for r in tables[5]:
        assert list(memoryview(bytes(r["ids"])).cast("I")) == REFERENCE.encode_ordinary(texts[r["doc_id"]])
    assert public_tokenizers.PATTERN
