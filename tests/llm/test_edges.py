"""Every operator and stage over nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import public_tokenizers
import pytest
from fixtures_llm import edge_docs, no_docs, schema  # noqa: F401
from tests_llm_data import EDGE_ROWS, LONG, PROSE
from pyspark.sql import functions as F

import corpus_pipeline
from dimflow.llm import bpe, exact, jaccard, lm, mixing, pii, quality, secret_scan, suffixes, wrappers

IDS = [r[0] for r in EDGE_ROWS]


def ids(rows, name="id"):
    return sorted(((r[name] is None, r[name] or 0) for r in rows))


def expected_ids():
    return sorted((i is None, i or 0) for i in IDS)


def test_quality(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (9, 0), (9, 0), (77, 0)], "doc_id long, quality int")
    model = quality.train(edge_docs, labels)
    rows = quality.score(edge_docs, model).select(F.col("doc_id").alias("id"), "text", "__quality.*").collect()
    assert ids(rows) == expected_ids()
    for r in rows:
        if not (r["text"] or "").strip():
            assert r["n_words"] == 0 and r["base_failed"] and not r["kept"]
    assert quality.train(no_docs, labels) is None
    assert quality.train(edge_docs, labels.where("false")) is None
    assert quality.score(no_docs, None).count() == 0
    unlearned = quality.score(edge_docs, None).select("__quality.*").collect()
    assert all(r["probability"] is None and r["kept"] != r["base_failed"] for r in unlearned)


def test_exact(edge_docs, no_docs):
    rows = exact.exact_groups(edge_docs).collect()
    assert ids(rows) == expected_ids()
    by = {}
    for r in rows:
        by.setdefault(r["id"], []).append(r)
    assert by[1][0]["keep_id"] == 2 and by[1][0]["group_size"] == 2 and not by[1][0]["kept"]
    assert by[3][0]["keep_id"] == 4 and by[3][0]["group_size"] == 3  # null counts as empty, also without an id
    nines = sorted((r["group_size"], r["kept"]) for r in by[9])
    assert nines == [(1, True), (2, False), (2, True)]  # of repeated rows one stays
    assert exact.exact_groups(no_docs).count() == 0
    assert exact.keep_one(no_docs).columns == no_docs.columns
    kept = exact.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({(t or "").lower() for _, t, *_ in EDGE_ROWS})


def test_suffixes(edge_docs, no_docs):
    rows = suffixes.remove_repeats(edge_docs).collect()
    assert ids(rows) == expected_ids()
    by = {r["id"]: r for r in rows}
    assert by[8]["n_removed"] == 50000 and by[8]["n_spans"] == 1 and bytes(by[8]["kept"]) == b""
    assert by[6]["n_removed"] == len(LONG)
    assert bytes(by[7]["kept"]) == b"tail"  # the blank before it ends a repeat too
    assert by[1]["n_removed"] == 0 and by[3]["n_bytes"] == 0
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_secrets(edge_docs, no_docs):
    findings, ledger = secret_scan.scan(edge_docs, "doc_id")
    rows = findings.collect()
    assert ids(rows, "path") == expected_ids()
    assert [len(r["spans"]) for r in rows if r["path"] == 9 and r["spans"]] == [1, 1]
    assert ledger.count() == 3 * len({t or "" for _, t, *_ in EDGE_ROWS})
    findings, ledger = secret_scan.scan(no_docs, "doc_id")
    assert findings.count() == 0 and ledger.count() == 0


def test_pii(edge_docs, no_docs):
    rows = pii.find_spans(edge_docs).collect()
    assert ids(rows) == expected_ids()
    assert [[s["kind"] for s in r["spans"]] for r in rows if r["id"] == 9 and r["spans"]] == [["email", "card"]] * 2
    assert pii.find_spans(no_docs).count() == 0


def test_jaccard(edge_docs, no_docs):
    rows = jaccard.link_classes(edge_docs).collect()
    assert ids(rows) == expected_ids()
    by = {(r["id"], r["n_shingles"]): r["component_id"] for r in rows}
    assert by[2, len(PROSE.split()) - 3] == 1
    assert by[3, 0] == 3 and by[5, 0] == 5
    assert {c for (i, _), c in by.items() if i in (6, 7)} == {6}
    assert jaccard.link_classes(no_docs).count() == 0
    kept = jaccard.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id in (1, 2, 6, 7)").collect()) == [1, 6]


def test_lm(edge_docs, no_docs):
    rows = lm.score(edge_docs).collect()
    assert ids(rows) == expected_ids()
    assert all(r["n_tokens"] == 1 for r in rows if r["id"] in (3, 4, 5))
    assert all(r["score"] < 0 and r["base_score"] <= 0 for r in rows)
    assert lm.score(no_docs).count() == 0
    only_held = edge_docs.where(~lm.training_row("doc_id"))
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in lm.score(only_held).collect())


def test_mixing(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert ids(rows) == expected_ids()
    assert all(0 <= r["copies"] <= 2 for r in rows)
    assert mixing.mix(no_docs).count() == 0
    mixed = mixing.repeat_rows(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixing.repeat_rows(no_docs).count() == 0


def test_bpe(edge_docs, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.encode(edge_docs, path, public_tokenizers.PATTERN).collect()
    assert ids(rows) == expected_ids()
    assert {r["n_tokens"] for r in rows if r["id"] in (3, 4)} == {0}
    assert bpe.encode(no_docs, path, public_tokenizers.PATTERN).count() == 0


def test_wrappers(spark):
    page = "<html><body><article><p>One &amp; two<p>three</article></body></html>"
    rows = [(1, "http://a.example/x", page), (1, "http://a.example/x", page), (2, None, page), (3, "http://[bad", None),
            (None, "http://a.example/y", ""), (4, "http://b.example", "<p>" + "long " * 40000),
            (5, "http://b.example", "plain text, <b no markup")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = wrappers.extract(pages).collect()
    assert len(found) == len(rows)
    assert {r["text"] for r in found if r["id"] in (1, 2)} == {"One & two\nthree"}
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in found if r["id"] in (3, None))
    assert next(r["n_chars"] for r in found if r["id"] == 4) == 199999
    assert wrappers.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("number", range(5))
def test_stages(spark, tmp_path_factory, edge_docs, no_docs, number):
    folder = tmp_path_factory.mktemp("labels")
    spark.createDataFrame([(1, 1), (9, 0), (None, 0)], "doc_id long, quality int").write.parquet(
        str(folder / "labels.parquet"))
    stage = corpus_pipeline.STAGES[number][1]
    for docs in (edge_docs, no_docs):
        out = stage(spark, docs, str(folder))
        if number < 4:
            assert out.columns == docs.columns
        assert out.count() <= 2 * len(EDGE_ROWS)
