"""Batches of encoded texts leave a task part by part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from dimflow.llm import bpe, hashing


def test_encoded_batches_leave_in_parts():
    encoder = bpe.Encoder({bytes([i]): i for i in range(256)}, r"\S+|\s+")
    texts = ["a" * 600_000, "b" * 600_000, "", "c"]
    parts = list(bpe.encoded(encoder, pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)],
                                                                 names=["id", "text"]), ["n_tokens", "ids"]))
    assert hashing.SLICE_BYTES < 1_200_000 and [p.num_rows for p in parts] == [1, 3]
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["n_tokens"] for r in rows] == list(map(len, texts))
    assert [np.frombuffer(r["ids"], np.uint32).astype(np.uint8).tobytes().decode() for r in rows] == texts
