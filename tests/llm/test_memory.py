"""What a task holds does not follow the length of its texts: Arrow batches, counters, remembered pairs."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimflow.llm import bpe, common, jaccard, quality

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(docs):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])
    return max(r["n"] for r in docs.mapInArrow(run, "n long").collect())


@pytest.fixture()
def vocabulary_file(tmp_path):
    import base64
    path = tmp_path / "bytes.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)))
    return str(path)


@pytest.mark.parametrize("operator", ["bpe", "jaccard", "quality"])
def test_batches_are_bounded_by_their_bytes(spark, vocabulary_file, operator):
    """1,600 texts of 10 KB, fewer than the rows of a batch, do not reach Python as one batch of 16 MB."""
    spark.conf.unset(BOUND)
    docs = spark.range(1600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word word "), 1000).alias("text")).coalesce(1)
    few = docs.limit(3)
    if operator == "bpe":
        assert {r["n_tokens"] for r in bpe.encode(few, vocabulary_file, r"\S+|\s+").collect()} == {10_000}
    elif operator == "jaccard":
        assert {r["component_id"] for r in jaccard.link_classes(few).collect()} == {0}
    else:
        assert quality.score(few, None).count() == 3
    assert largest_batch(docs.select("text")) < 2 * common.BATCH_BYTES


def test_a_bound_of_the_session_stays(spark, vocabulary_file):
    spark.conf.set(BOUND, "1000000")
    try:
        bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), vocabulary_file, r"\S+")
        assert spark.conf.get(BOUND) in ("1000000", "1000000b")
    finally:
        spark.conf.unset(BOUND)


def test_shingles_are_counted_in_place():
    """The counters are there once; equal shingles of several sets and far cells count."""
    cells = np.zeros(jaccard.CELLS, np.uint32)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 500, np.uint64)) for _ in range(20)] + [np.zeros(0, np.uint64)]
    sets.append(sets[0])
    tracemalloc.start()
    try:
        jaccard.add_sets(cells, sets)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    expected = np.bincount(jaccard._cell(np.concatenate(sets)).astype(np.int64), minlength=jaccard.CELLS)
    assert (cells == expected).all() and cells.sum() == sum(map(len, sets))
    assert most < jaccard.CELLS


def test_remembered_pairs_keep_their_room(monkeypatch):
    """However many pairs of tokens occur, they take the same memory; pairs that share a place do not mix."""
    monkeypatch.setattr(bpe, "PAIRS", 7)
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258, b"aa": 259, b"aaa": 260}
    few = bpe.Encoder(ranks, r"\S+|\s+")
    rng = np.random.default_rng(6)
    text = " ".join("".join(rng.choice(list("abcd"), 12)) for _ in range(500))
    got = np.frombuffer(few.encode(text), np.uint32).tolist()
    import regex
    expected = [i for piece in regex.findall(r"\S+|\s+", text) for i in few.vocabulary.merge(piece.encode())]
    assert got == expected and len(few.vocabulary.pairs) == len(few.vocabulary.fits) == 7
