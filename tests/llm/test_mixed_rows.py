"""The mix's rows: every document as often as the mix takes it, whatever the bitmaps can tell."""

from __future__ import annotations

from collections import Counter

import pytest
from fixtures_llm import small_docs  # noqa: F401
from pyspark.sql import functions as F

from dimflow.llm import mixing


@pytest.mark.parametrize("bits", [1 << 23, 1 << 15])
def test_rows_follow_the_copies(small_docs, monkeypatch, bits):
    """Also with bitmaps so small that many rows are in doubt; then these are joined."""
    monkeypatch.setattr(mixing, "filter_bits", lambda keys: bits)
    docs = small_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    if bits < 1 << 20:
        docs = docs.crossJoin(docs.sparkSession.range(40).withColumnRenamed("id", "more")).select(
            (F.col("doc_id") * 100 + F.col("more")).alias("doc_id"), "text", "source")
    expected = {r["id"]: r["copies"] for r in mixing.mix(docs).collect()}
    got = Counter(r["doc_id"] for r in mixing.repeat_rows(docs).select("doc_id").collect())
    assert got == Counter({i: n for i, n in expected.items() if n}) and {0, 2} & set(expected.values())
