"""Steps that do no more than they have to: components, hub rounds."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import components, jaccard


def test_settled_components_take_no_further_step(spark, monkeypatch):
    steps = []
    real = components.staged
    monkeypatch.setattr(components, "staged", lambda df, name, *more: steps.append(name) or real(df, name, *more))
    edges = spark.createDataFrame([(i, 7) for i in range(8, 60)] + [(3, 5), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {n: 7 for n in range(7, 60)} | {3: 3, 5: 3}
    assert steps.count("cc_step") == 1


def test_hub_rounds_end_when_they_find_nothing(spark, monkeypatch):
    """A round without a link is the last one; the blocks then find what links there are."""
    monkeypatch.setattr(jaccard, "HOT", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rounds = []
    real = jaccard._next_hubs
    monkeypatch.setattr(jaccard, "_next_hubs", lambda *args: rounds.append(1) or real(*args).where("false"))
    rng = random.Random(3)
    docs = []
    for i in range(60):
        words = [f"w{k}" for k in range(80)]
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_classes(frame).collect()}
    assert got == brute.components(docs) and len(rounds) == 1


def test_a_star_is_computed_once(spark, monkeypatch):
    """Each step reads the edges that the step before has written, and lists no edge by both of its ends."""
    plans = []
    real = components.staged
    monkeypatch.setattr(components, "staged", lambda df, name, *more: plans.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString())) or real(df, name, *more))
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r["root"] for r in components.components(edges).collect()} == {0}
    assert len(plans) > 3 and not any("Generate" in plan for _, plan in plans)
    assert all(plan.count("Relation") <= 3 and plan.count("Join") == 1 for name, plan in plans if name != "cc_edges")


@pytest.mark.parametrize("alike", [True, False])
def test_links_of_a_family_grow_with_its_size(spark, monkeypatch, alike):
    """Blocks of a family whose sets are still apart report links in proportion to it, not to the pairs of blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    counts = []
    real = jaccard.staged

    def kept(df, name, *more):
        out = real(df, name, *more)
        if name == "jaccard_family_links":
            counts.append(out.count())
        return out
    monkeypatch.setattr(jaccard, "staged", kept)
    n = 160
    rng = np.random.default_rng(3)
    common = rng.integers(1, 1 << 40, 60, np.uint64)
    sets = []
    for i in range(n):
        own = rng.integers(1 << 41, 1 << 42, 2 if alike else 1 + i % 8, np.uint64)
        sets.append(np.sort(np.concatenate([common, own])))
    keys = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sets)], "key long, shingles binary")
    rooted = spark.createDataFrame([(i, i) for i in range(n)], "set_key long, root long")
    family = rooted.withColumn("hub", F.lit(1).cast("long")).select("hub", "set_key", "root")
    none = spark.createDataFrame([], "a long, b long")
    joins = jaccard._family_joins(jaccard._with_rest(family), none, keys, 92, rooted, 1)
    expected = brute.Sets(range(n))
    for a in range(n):
        for b in range(a):
            common_size = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common_size >= 92 * (len(sets[a]) + len(sets[b]) - common_size):
                expected.union(a, b)
    found = {r["node"]: r["root"] for r in components.components(joins).collect()}
    assert {i: found.get(i, i) for i in range(n)} == {i: expected.find(i) for i in range(n)}
    assert sum(counts) <= 2 * jaccard.BAND * n
