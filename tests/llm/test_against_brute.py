"""Operators against plain versions on a small table."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import brute
import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from fixtures_llm import small_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests_llm_data import SMALL

from dimflow.llm import bpe, components, exact, jaccard, lm, mixing, oracle_sql, pii, quality, queries, secret_scan
from dimflow.llm import suffixes, wrappers

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def documents(small_docs):
    return [(r["doc_id"], r["text"]) for r in small_docs.collect()]


def test_measures(small_docs):
    rows = quality.score(small_docs, None).select("doc_id", "text", "__quality.*").collect()
    for r in rows:
        expected = brute.measures(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])


@given(st.lists(st.sampled_from("ab"), max_size=30))
def test_repeated_words(tokens):
    text = " ".join(tokens)
    assert quality.measure(text)[4] == brute.measures(text)[4]


@given(st.text(alphabet="aA \n\t\x0b\x85\xa0é|#", max_size=60))
def test_measures_of_any_text(text):
    assert quality.measure(text) == brute.measures(text)


def test_quality_on_unseen_rows(spark):
    """Trained on half of the labelled rows, the verdict separates the other half."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    half = F.xxhash64("doc_id") % 2 == 0
    model = quality.train(docs, labels.where(half))
    rows = quality.score(docs.join(labels.where(~half), "doc_id"), model).select("quality", "__quality.*").collect()
    judged = [r for r in rows if not r["base_failed"]]
    right = sum(r["kept"] == (r["quality"] == 1) for r in judged)
    good = [r for r in judged if r["quality"] == 1]
    assert right >= 0.95 * len(judged) and sum(r["kept"] for r in good) >= 0.98 * len(good)


def test_suffixes(small_docs):
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffixes.remove_repeats(small_docs).collect()}
    assert got == brute.without_repeats(documents(small_docs))


def test_suffixes_at_the_edges(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = noise(900)
    texts = [noise(300) + passage + noise(50), passage[:399], passage[:400], passage[100:501] + noise(500),
             noise(10) + passage[300:700] + passage[299:700], "é" * 300, "aé" * 400, passage[500:] + noise(900),
             "ab" * 900, noise(700) + passage[1:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffixes.remove_repeats(docs).collect()}
    assert got == brute.without_repeats(enumerate(texts))


def test_counted_buckets_agree_with_sorted_ones(spark, small_docs):
    """The way for buckets of any size finds the same suffixes as sorting a bucket in one task."""
    base = small_docs.limit(3).collect()
    text = "".join(r["text"] for r in base)[:1500].ljust(1500, "z").encode()
    rows = [(1, 1, 112, 1, bytearray(text[:500])), (1, 2, 110, 1, bytearray(text[2:498] + b"!")),
            (1, 3, 90, 2, bytearray(text[22:422])), (2, 4, 50, 1, bytearray(text[700:1200])),
            (2, 5, 40, 1, bytearray(text[710:1300]))]
    spans = spark.createDataFrame(rows, "core long, span long, distance int, times long, bytes binary")
    flat = lambda df: {(r["span"], r["first"] + i) for r in df.collect() for i in range(r["number"])}
    found = flat(suffixes._sorted_buckets(spans))
    assert found == flat(suffixes._counted_buckets(spans)) and {s for s, _ in found} == {1, 2, 3, 4, 5}


def test_runs_in_chunks(monkeypatch):
    """Texts beyond a chunk: every suffix is in exactly one run, in whatever chunks the text is read."""
    data = np.frombuffer(random.Random(1).randbytes(3000), np.uint8)
    for chunk in (suffixes.CHUNK, 500, 777):
        monkeypatch.setattr(suffixes, "CHUNK", chunk)
        covered = [p for _, _, start, n, _ in suffixes.runs(data) for a, k in zip(start, n) for p in range(a, a + k)]
        assert covered == list(range(len(data) - suffixes.LENGTH + 1))


def test_jaccard(small_docs):
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_classes(small_docs).collect()}
    assert got == brute.components(documents(small_docs))


@pytest.mark.parametrize("hot, block", [(jaccard.HOT, jaccard.BLOCK), (2, 16), (2, 2)])
def test_jaccard_family(spark, monkeypatch, hot, block):
    """A family of near copies at all distances around the threshold, some linked only through others."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        texts.append(" ".join(words[:rng.randrange(70, 81)]))
    docs = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(texts[:20])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80)):
        got = {r["id"]: (r["n_shingles"], r["component_id"])
               for r in jaccard.link_classes(frame, width=width, percent=percent).collect()}
        assert got == brute.components(docs, width, percent)


def test_families_of_several_components(spark, monkeypatch):
    """Settled families go, the others meet in every pair that can join components, with copies linear in their size."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = [(1, i, 0) for i in range(500)]  # one component: done
    rows += [(2, i, 0) for i in range(1000)] + [(2, 1000 + i, 1 + i % 3) for i in range(12)]  # a rest of one block
    rows += [(3, i, i) for i in range(60)]  # no two alike
    rests = jaccard._with_rest(spark.createDataFrame(rows, "hub long, set_key long, root long"))
    assert {(r["hub"], r["n_rest"], r["n_major"]) for r in rests.select("hub", "n_rest", "n_major").distinct().collect()
            } == {(2, 12, 1000), (3, 59, 1)}
    met, copies = set(), {2: 0, 3: 0}
    blocks = {}
    for r in jaccard._dealt(rests).collect():
        copies[r["hub"]] += 1
        blocks.setdefault((r["hub"], r["one"], r["two"]), []).append((r["set_key"], r["root"], r["own"]))
    for (hub, one, two), found in blocks.items():
        met |= {(hub, min(a, b), max(a, b)) for a, ra, oa in found for b, rb, ob in found
                if oa == one and ob == two and ra != rb}
    assert met == {(h, min(a, b), max(a, b)) for h, a, ra in rows for k, b, rb in rows if h == k and ra != rb}
    assert copies[2] <= 2 * 1012
    assert {(r["b"], r["a"] in range(60)) for r in jaccard._next_hubs(rests).collect()
            } == {(jaccard._next_hubs(rests).first()["b"], True)}  # one set of family 3 alone meets the others


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    joined = brute.Sets(range(500))
    for a, b in edges:
        joined.union(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: joined.find(n) for e in edges if e[0] != e[1] for n in e}


def test_unigram_scores(small_docs):
    expected = brute.unigram(documents(small_docs))
    rows = lm.score(small_docs).collect()
    assert len(rows) == len(expected)
    for r in rows:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[r["id"]][:3]
        assert r["base_score"] == pytest.approx(expected[r["id"]][3], rel=1e-9)
        assert r["held_out"] == brute.held_out(r["id"])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # better on texts not learnt from


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    weights = [rng.normal(size=(lm.FEATURES, n)).astype(np.float32) for n in (lm.CLASSES, lm.MEMBERS)]
    contexts = lm.mix(np.arange(4, dtype=np.uint64))[None, :].repeat(lm.CLASSES, 0)
    by_class, by_member = lm._factors(contexts, np.arange(lm.CLASSES))
    total = (lm._softmax(weights[0], by_class)[0] * lm._softmax(weights[1], by_member).sum(1)).sum()
    assert total == pytest.approx(1, abs=1e-5)


def test_lm_gradient_steps_learn():
    texts = pa.array(["one two three four " * 50] * 40)
    hashes, first = lm.token_hashes(texts)
    weights = [np.zeros((lm.FEATURES, n), np.float32) for n in (lm.CLASSES, lm.MEMBERS)]
    before = lm.log_probability(weights, hashes, first).mean()
    for _ in range(5):
        lm.gradient_steps(weights, hashes, first, lm.RATE)
    assert lm.log_probability(weights, hashes, first).mean() > before / 2


@given(st.dictionaries(st.one_of(st.none(), st.text(min_size=1, max_size=2)), st.integers(0, 1000), min_size=1,
                       max_size=8))
@settings(max_examples=8, deadline=None)
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(brute.targets(sizes), rel=1e-9, abs=1e-6)


def test_mix(small_docs):
    rows = mixing.mix(small_docs, block=16).collect()
    assert sorted(rows) == sorted(mixing.mix(small_docs.repartition(7), block=16).collect())  # reruns agree
    sizes, taken = {}, {}
    for r in rows:
        assert 0 <= r["copies"] <= 2 and r["size"] == len(brute.words({i: t for i, t in documents(small_docs)}[r["id"]]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    goals = brute.targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goals[r["source"]])
    largest = {s: max(r["size"] for r in rows if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - goals[s]) <= largest[s] for s in sizes)
    copies = {}
    for r in rows:
        copies[r["id"]] = r["copies"]
    mixed = pd.Series([r["doc_id"] for r in mixing.repeat_rows(small_docs, block=16).collect()]).value_counts()
    assert mixed.to_dict() == {i: n for i, n in copies.items() if n}


@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(0, 500)), max_size=60), st.integers())
def test_flight_keeps_both_totals(rows, seed):
    units = [[p, float(s)] for p, s in rows]
    left = mixing.flight(units, random.Random(seed))
    assert len(left) <= 2
    assert all(u[0] in (0.0, 1.0) for i, u in enumerate(units) if i not in left)
    assert sum(u[0] for u in units) == pytest.approx(sum(p for p, _ in rows), abs=1e-6)
    assert sum(u[0] * u[1] for u in units) == pytest.approx(sum(p * s for p, s in rows), abs=1e-3)


@given(st.text(max_size=80))
def test_bpe(text):
    packed = ENCODER.encode(text)
    assert list(memoryview(packed).cast("I")) == REFERENCE.encode_ordinary(text)
    assert ENCODER.decode(packed) == text.encode()


@given(st.binary(max_size=30), st.binary(max_size=10), st.integers(0, 30), st.integers(0, 10))
def test_prefix_table_appends_and_edits(data, more, at, length):
    at = min(at, len(data))
    length = min(length, len(data) - at)
    whole = lambda b: bpe.PrefixTable(ENCODER.vocabulary, b)
    grown = whole(data).append(more)
    assert grown.last == whole(data + more).last and grown.ids() == whole(data + more).ids()
    edited = whole(data).replace(at, length, more)
    assert edited.ids() == whole(data[:at] + more + data[at + length:]).ids()


def test_bpe_query(small_docs):
    rows = bpe.encode(small_docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    texts = dict(documents(small_docs))
    for r in rows:
        ids = REFERENCE.encode_ordinary(texts[r["id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["id"]].encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(oracle_sql.ORACLE))
def test_oracles(spark, name):
    got = queries.REGISTRY[name](spark, SMALL).toPandas()
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = con.execute(oracle_sql.ORACLE[name]).df()
    order = sorted(got.columns)
    assert order == sorted(expected.columns)
    keys = [c for c in ("doc_id", "vec_id", "lang", "source", "part", "rank") if c in order]
    by_id = lambda df: df[order].sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(by_id(got), by_id(expected), check_dtype=False)


def test_personal_data_in_a_text_of_many_matches(spark):
    """Positions and contexts of thousands of matches, other characters between them."""
    rng = random.Random(6)
    text = "".join(f"{'mail ' if i % 7 == 0 else '\U0001F600' * rng.randrange(3) + 'x ' * rng.randrange(30)}u{i}@ex.org "
                   for i in range(4000))
    spans = pii.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]["spans"]
    words = re.compile(pii.CONTEXT_WORDS)
    expected = [(m.start(), m.end(), 70 + 20 * bool(words.search(text[max(0, m.start() - pii.CONTEXT):m.start()].lower())))
                for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert [(s["start"], s["end"], s["score"]) for s in spans] == expected and len(expected) == 4000


def test_suffixes_of_a_long_text_of_repeats(spark):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passages = [noise(450) for _ in range(20)]
    text = "".join(rng.choice(passages) + noise(rng.randrange(50)) for _ in range(250))
    rows = [(1, text), (2, noise(2000)), (3, text[5000:5600])]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} \
        == brute.without_repeats(rows)


def test_encoder_forgets_without_harm(monkeypatch):
    """With room for a few pieces and pairs only, the ids stay the same."""
    monkeypatch.setattr(bpe, "CACHED", 3)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN, ENCODER.vocabulary.halves)
    for text in ["the quick brown fox " * 3 + "zzqxj vvbnm1234 the quick", "quick quickly, ünïcode \U0001F600 the"] * 2:
        assert list(memoryview(encoder.encode(text)).cast("I")) == REFERENCE.encode_ordinary(text)


def test_secret_scan_with_full_bitmaps(spark, monkeypatch):
    """Bitmaps that name nearly every row cost scans, not findings or doubled ledger rows."""
    rows = [(i % 37 if i % 5 else None, f"token = {'k' * 12}{i % 50} and {i % 50:016x}" if i % 3 else "plain")
            for i in range(300)]
    history = spark.createDataFrame(rows, "path long, text string")
    findings, ledger = secret_scan.scan(history)
    expected = sorted(map(str, findings.collect()))
    first = secret_scan.scan(history.where("path < 20"))[1]
    grown = secret_scan.scan(history, ledger=first)
    monkeypatch.setattr(secret_scan, "filter_bits", lambda keys: 8)
    full, again = secret_scan.scan(history)
    more, new = secret_scan.scan(history, ledger=first)
    assert sorted(map(str, full.collect())) == expected == sorted(map(str, more.collect()))
    assert sorted(map(str, grown[0].collect())) == expected
    blobs = len({text for _, text in rows})
    assert ledger.count() == again.count() == first.count() + new.count() == 3 * blobs
    assert grown[1].count() == new.count() > 0


def test_wanted_blobs_are_a_narrow_table(spark):
    rows = spark.range(10).select(F.col("id").alias("path"), F.col("id").cast("string").alias("__text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("__text", 256)))
    plans = []
    for ledger in (None, secret_scan.scan(rows.withColumnRenamed("__text", "text").where("path < 4"))[1]):
        plans.append(secret_scan._wanted(rows, ledger, secret_scan.RULES))
        assert plans[-1].columns == ["blob", "key", "many", "rules"]
    assert [p.count() for p in plans] == [10, 6]


def test_ledger_scans_only_what_is_new(spark):
    history = spark.createDataFrame(
        [("a", "token = abcdefghijkl01"), ("b", "token = abcdefghijkl01"), ("c", "nothing")], "path string, text string")
    findings, ledger = secret_scan.scan(history)
    assert {r["path"]: len(r["spans"]) for r in findings.collect()} == {"a": 1, "b": 1, "c": 0}
    assert ledger.count() == 6  # two blobs, three rules
    grown = history.union(spark.createDataFrame([("d", "token = abcdefghijkl01"), ("e", "AKIA" + "Z" * 16)],
                                                history.schema))
    findings, new = secret_scan.scan(grown, ledger=ledger)
    assert new.select("blob").distinct().count() == 1  # one blob was unseen
    assert {r["path"]: len(r["spans"]) for r in findings.collect()} == {"a": 1, "b": 1, "c": 0, "d": 1, "e": 1}
    rules = list(secret_scan.RULES)
    rules[1] = secret_scan.Rule("access", 2, *[getattr(rules[1], f) for f in ("pattern", "least", "hint")])
    _, again = secret_scan.scan(grown, ledger=ledger.union(new), rules=rules)
    assert {(r["rule"], r["version"]) for r in again.collect()} == {("access", 2)} and again.count() == 3


def plain_spans(kind, text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(d))) % 10 == 0
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    pattern, holds = rules[kind]
    return [(m.start(), m.end()) for m in re.finditer(pattern, text) if holds(m.group())]


def test_pii_on_hard_texts(spark):
    rng = random.Random(11)
    alphabet = list("ab1@.-+ ()") + ["a@b.c", "1.2.3.4", "4111111111111111", "+1 555 123 4567", "é", "\U0001F600", "0"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(400)]
    texts += ["1" * 20000, "1 " * 9000, "a." * 9000 + "@x.y" + ".z" * 9000, "x@y" + ".a" * 20000, "+" * 5000,
              "1.1" * 5000, "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "DE88 3704 0044 0532 0130 00"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_spans(docs).collect():
        for kind in ("email", "ip", "card", "phone"):
            got = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == kind]
            assert got == plain_spans(kind, texts[r["id"]]), (kind, texts[r["id"]][:80])
    accounts = {r["id"]: [s for s in r["spans"] if s["kind"] == "iban"] for r in pii.find_spans(docs).collect()}
    assert len(accounts[len(texts) - 2]) == 2 and not accounts[len(texts) - 1]


def test_secrets_on_hard_texts(spark):
    rng = random.Random(12)
    alphabet = ["token", "Secret", "api_key", "=", ":", " ", '"', "abcdef0123456789", "AKIA", "ABCD", "x", "é", "f00"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(25))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    plain = {
        "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        "access": (r"AKIA[A-Z0-9]+", 0, 18), "hex": (r"[0-9a-f]+", 0, 16)}
    for r in secret_scan.scan(docs)[0].collect():
        expected = sorted((m.start(), list(plain).index(kind), m.end(), kind) for kind, (p, g, least) in plain.items()
                          for m in re.finditer(p, texts[r["path"]]) if len(m.group(g)) >= least)
        assert [(s["start"], s["end"], s["kind"]) for s in r["spans"]] == [(a, b, k) for a, _, b, k in expected]


def test_exact_refinement_levels(spark):
    """Same length, same prefix, different ends: each level leaves only what may still repeat."""
    prefix = "p" * exact.PREFIX_CHARS
    texts = [prefix + "one", prefix + "ONE", prefix + "two", "q" * len(prefix) + "two", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["id"]: r for r in exact.exact_groups(docs).collect()}
    assert [rows[i]["keep_id"] for i in range(5)] == [1, 1, 2, 3, 4]
    assert rows[4]["digest"] is None and rows[3]["digest"] is None  # settled by length or prefix
    plan = exact.exact_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_wrapper_alignment():
    page = ("<html><body><div class='top-menu'><a href=/>Home</a></div><div class=content><h2>A</h2><p>one</p>"
            "<p>two <b>bold</b>ly</p>{extra}</div><div id='comments'><p>nice</p></div></body></html>")
    one, words = wrappers.skeleton(page.format(extra=""))
    two, _ = wrappers.skeleton(page.format(extra="<ul><li>x<li>y</ul>"))
    text = wrappers.to_text(wrappers.align(one, two))
    assert "ul[li[#]+]?" in text and "p[#]+" in text
    container = wrappers.choose({k: tuple(v) for k, v in words.items()})
    assert container == "/html/body/div.content"
    assert wrappers.main_text(page.format(extra="<h2>B</h2><p>x &lt;&nbsp; y"), container) == \
        "A\none\ntwo boldly\nB\nx < y"


def test_repeated_groups_fold():
    tree, _ = wrappers.skeleton("<dl><dt>a<dd>b<dt>c<dd>d<dd>e<dt>f<dd>g</dl>")
    assert wrappers.to_text(tree) == "dl[(dt dd)[dt[#] dd[#]+]+]"


def test_pages_of_the_table(spark):
    """The article of every page, against a reader that knows the table's one template."""
    import html
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in wrappers.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", source[r["id"]], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in
                 re.split(r"</?(?:p|h1|br)>", article)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])
