"""The language model's feature rows grow with the training text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from dimflow.llm import lm

TEXTS = [" ".join(f"w{(i * j) % 97}" for j in range(1, 200)) for i in range(1, 40)]


def test_shards_follow_the_training_text():
    assert [lm.feature_shards(n) for n in (0, 1, 2 << 30, (2 << 30) + 1, 40 << 30)] == [1, 1, 1, 2, 20]


def test_sharded_training_is_the_average_of_its_tasks(spark):
    parts = [[" ".join(TEXTS[:10])], [" ".join(TEXTS[10:])]]  # a document for each task
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(t,) for part in parts for t in part], 2), "text string")
    found = lm._unpack(lm.train(docs, rounds=1, shards=3))
    assert [w.shape for w in found] == [(3 * lm.FEATURES, lm.CLASSES), (3 * lm.FEATURES, lm.MEMBERS)]
    total, tokens = [0.0, 0.0], 0
    for part in parts:
        hashes, first = lm.token_hashes(pa.array(part))
        own = [np.zeros_like(w) for w in found]
        lm.gradient_steps(own, hashes, first, lm.RATE)
        total = [t + len(hashes) * w for t, w in zip(total, own)]
        tokens += len(hashes)
    for w, t in zip(found, total):
        assert w.any() and np.allclose(w, t / tokens, atol=1e-4)
    assert len(np.flatnonzero(found[1][lm.FEATURES:].any(1))) > 0  # rows of later shards learn, too


def test_scores_with_several_shards(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 10_000)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    several = {r["id"]: r["score"] for r in lm.score(docs).collect()}
    monkeypatch.undo()
    one = {r["id"]: r["score"] for r in lm.score(docs).collect()}
    assert several.keys() == one.keys() and all(np.isfinite(x) for x in several.values()) and several != one
