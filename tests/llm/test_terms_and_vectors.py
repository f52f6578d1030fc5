"""Super-k-mer dedup, source divergence and centroid clustering against plain versions and at the edges."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures_llm import edge_docs, no_docs, schema, small_docs  # noqa: F401
from tests_llm_data import EDGE_ROWS, LONG, SMALL
from pyspark.sql import functions as F

from dimflow.llm import clustering, divergence, superkmers

# ---- super-k-mers --------------------------------------------------------------------------------


def without_repeats(texts, width=35):
    """(words, removed, sha256 of the rest) of each text."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for j in range(i, i + width)}
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return out


def assert_same(df, rows):
    got = sorted((str(r["id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())
    assert got == sorted((str(i), *e) for (i, _), e in zip(rows, without_repeats([t for _, t in rows])))


def planted(seed=3):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    passage = words(60)
    texts = [words(80) + passage[:n] + words(rng.randrange(60)) for n in (60, 35, 34, 36, 50, 35)]
    texts += [passage, words(35), ["a"] * 90, ["a", "b"] * 60, passage[5:45] + passage[5:45], words(34), []]
    texts += [words(20) + passage[10:55] + words(20) for _ in range(40)]  # one passage, many surroundings
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(100, "\t\n  ".join(passage[:40])), (101, " ".join(passage).upper()), (102, None), (None, rows[0][1])]
    return rows + [(7, rows[0][1]), (7, rows[0][1])]


@pytest.mark.parametrize("bucket_bytes", [superkmers.BUCKET_BYTES, 600])
def test_superkmers_on_planted_passages(spark, monkeypatch, bucket_bytes):
    """Also with buckets so small that all are cut to single windows."""
    monkeypatch.setattr(superkmers, "BUCKET_BYTES", bucket_bytes)
    rows = planted()
    assert_same(superkmers.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_superkmers_with_hot_keys_spread(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "BUCKETS_PER_TASK", 1)
    rng = random.Random(9)
    copy = " ".join(f"c{rng.randrange(900)}" for _ in range(120))
    rows = [(i, copy if i % 3 == 0 else " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(40))) for i in range(240)]
    assert_same(superkmers.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_superkmers_on_the_table(small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    assert_same(superkmers.remove_repeats(small_docs), rows)


def test_superkmers_do_not_depend_on_blocks(monkeypatch):
    values = np.random.default_rng(1).integers(0, 50, 3000).astype(np.uint64)
    first = np.array([0, 20, 20, 900, 935, 3000])
    windows = lambda: sorted((int(t), int(a) + i, int(k)) for found in superkmers.super_kmers(values, first)
                             for k, t, a, n in zip(*found) for i in range(n))
    whole = windows()
    assert [(t, a) for t, a, _ in whole] == [(t, a) for t in range(5)
                                             for a in range(max(0, int(first[t + 1] - first[t]) - 34))]
    monkeypatch.setattr(superkmers, "CHUNK", 100)
    assert windows() == whole


def test_superkmers_edges(edge_docs, no_docs):
    rows = superkmers.remove_repeats(edge_docs).collect()
    assert sorted((r["id"] is None, r["id"] or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in EDGE_ROWS)
    by = {r["id"]: r for r in rows if r["id"] != 9}
    assert by[6]["n_removed"] == len(LONG.split()) and bytes(by[7]["kept"]) == b"tail"
    assert by[1]["n_removed"] == by[8]["n_removed"] == by[3]["n_words"] == by[5]["n_words"] == 0
    assert superkmers.remove_repeats(no_docs).count() == 0


# ---- divergence ----------------------------------------------------------------------------------


def plain_audit(rows):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [((la or ""), (so or ""), term.findall((t or "").translate(upper))) for t, la, so in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for la, _, ts in docs if la == lang for t in set(ts))
        kept = {t for t, n in df.items() if n >= 3}
        counts = defaultdict(Counter)
        for la, so, ts in docs:
            if la == lang:
                counts[so].update(t for t in ts if t in kept)
                counts[None].update(t for t in ts if t in kept)
        p = {g: {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for g, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for g in p.keys() - {None}:
            pair = [(sum(f(p[g][t], p[h][t]) for t in kept), h) for h in p.keys() - {None, g}]
            terms = [(f(p[g][t], p[None][t]), t) for t in kept if counts[g][t] and p[g][t] > p[None][t]]
            for part, found, most in (("pair", pair, None), ("term", terms, 200)):
                for rank, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, g, part, item, v, rank))
    return sorted(out)


def audited(df):
    return sorted(tuple(r) for r in divergence.audit(df).collect())


def test_divergence_on_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert audited(docs) == plain_audit([(r["text"], r["lang"], r["source"]) for r in docs.collect()])


@pytest.mark.parametrize("shard_rows, cells, held", [(1 << 17, 1 << 20, 1 << 18), (50, 64, 20)])
def test_divergence_of_many_terms(spark, monkeypatch, shard_rows, cells, held):
    """More than 200 reported terms with ties; also in many shards, blocks and partial counts."""
    for name, value in (("SHARD_ROWS", shard_rows), ("CELLS", cells), ("HELD_ROWS", held)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(2)
    rows = [(" ".join("x" + "abcdefghij"[k % 10] + "klmnopqrst"[k // 10 % 10] + "UVÄÖ"[k // 100]
                      for k in (rng.randrange(400) for _ in range(rng.randrange(400)))), lang, source)
            for lang in ("en", "de", None) for source in ("a", "b", "", None, "é") for _ in range(4)]
    rows += [("once only", "fr", "a"), (None, "fr", "b"), ("alone", "es", "a"), ("A\x00a\x7fa 中文", "en", "z"),
             ("", "", "quiet")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = audited(df.withColumn("value", F.lit("clash")).withColumn("n", F.lit("clash")))
    assert got == plain_audit(rows)
    assert max(r[5] for r in got if r[2] == "term") == 200


def test_shares_are_exact():
    counts = np.array([0, 1, 7, 10 ** 12, 9 * 10 ** 14], np.int64)
    for total in (1, 3, 10 ** 9 + 7, 10 ** 15):
        expected = [1 + 10 ** 9 * (int(c) + 1) // total for c in counts if c < total]
        assert divergence.shares(counts[counts < total], np.int64(total)).tolist() == expected


def test_divergence_edges(edge_docs, no_docs):
    assert audited(edge_docs) == plain_audit([(r[1], r[2], r[3]) for r in EDGE_ROWS])
    assert divergence.audit(no_docs).collect() == []


# ---- clustering ----------------------------------------------------------------------------------


def plain_clusters(vectors, k, rounds):
    """Clusters, distances and centroids; ``vectors`` as lists of (id, integers) in any order."""
    order = sorted(vectors, key=lambda v: (v[0] is None, hashlib.sha256(f"3:{v[0]}".encode()).hexdigest(), v[1]))
    centres = [list(v) for _, v in order[:k]]
    distance = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(centres)), key=lambda j: (distance(v, centres[j]), j))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in vectors:
            groups[nearest(v)].append(v)
        for j, members in groups.items():
            centres[j] = [sum(x) // len(members) for x in zip(*members)]
    own = [(i, nearest(v)) for i, v in vectors]
    return sorted(((str(i), j, distance(v, centres[j])) for (i, j), (_, v) in zip(own, vectors))), centres


def integers(vector):
    return [int(np.floor(1024 * float(x))) for x in vector]


@pytest.mark.parametrize("seed", range(3))
def test_clusters_of_random_vectors(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, 6))
    data = [(int(i), [float(x) for x in centres[i % 5] + rng.normal(0, 0.4, 6)]) for i in range(400)]
    data += [(i + 1000, data[0][1]) for i in range(60)] + [(5, data[5][1]), (None, [0.0] * 6)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    got, last = clustering.cluster(df, clusters=7, rounds=6, dims=6)
    expected, final = plain_clusters([(i, integers(v)) for i, v in data], 7, 6)
    assert sorted((str(r["id"]), r["cluster"], r["distance"]) for r in got.collect()) == expected
    assert last.tolist() == final


def test_bounds_skip_distances_and_stay_exact():
    """Over many rounds of slow drift: the same clusters as by all distances, with far fewer of them."""
    rng = np.random.default_rng(4)
    base = rng.integers(-2000, 2000, (8, 16))
    vectors = (base[rng.integers(0, 8, 3000)] + rng.integers(-300, 300, (3000, 16))).astype(np.int64)
    history = base[None].astype(np.int64)
    near, seen, own = clustering.first_assign(vectors, history[0])
    evaluated = 0
    for _ in range(12):
        # back and forth: the norm of the sum stays small where the sum of norms would grow
        history = np.concatenate([history, (history[0] + rng.integers(-40, 40, base.shape))[None]])
        evaluated += clustering.assign(vectors, history, near, seen, own)
        every = np.stack([clustering.squared(vectors, c) for c in history[-1]], 1)
        assert (own == every.argmin(1)).all()
    assert evaluated < 0.1 * 12 * 3000 * 8


def test_ties_go_to_the_smaller_number():
    centres = np.array([[[5, 5], [0, 4], [4, 0], [0, 4]]])
    vectors = np.array([[0, 0], [2, 2], [0, 4]], np.int64)
    near, seen, own = clustering.first_assign(vectors, centres[0])
    assert own.tolist() == [1, 1, 1]
    history = np.concatenate([centres, centres])
    clustering.assign(vectors, history, near, seen, own)
    assert own.tolist() == [1, 1, 1]
    moved = np.concatenate([history, np.array([[[5, 5], [0, 5], [4, 0], [0, 4]]])])
    clustering.assign(vectors, moved, near, seen, own)
    assert own.tolist() == [2, 2, 3]


def test_cluster_edges(spark):
    good = [float(i) / 64 for i in range(64)]
    rows = [(1, good), (2, None), (3, []), (4, good[:63]), (5, good[:63] + [None]), (6, good[:63] + [float("nan")]),
            (7, good[:63] + [float("inf")]), (1, good), (None, [x + 1 for x in good]), (8, [1e38] * 64), (9, [-1e300] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash"))
    assigned, centres = clustering.cluster(df)
    got = clustering.with_inertia(assigned, centres).collect()
    assert sorted((r["id"] is None, r["id"] or 0) for r in got) == [(False, 1), (False, 1), (False, 8), (False, 9), (True, 0)]
    assert len({r["cluster"] for r in got if r["id"] == 1}) == 1 and all(r["distance"] == 0 for r in got)
    assert all(r["inertia"] == 0 and r["cluster_inertia"] == 0 for r in got)
    assigned, centres = clustering.cluster(df.where("vec_id in (2, 3)"))
    assert clustering.with_inertia(assigned, centres).collect() == [] and len(centres) == 0
    assert clustering.quantise(pa.array([[0.5, -0.0001] + [0.0] * 62])).tolist()[0][:2] == [512, -1]
