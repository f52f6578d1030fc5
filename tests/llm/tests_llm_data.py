"""Rows that every operator is tried on."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"
PROSE = ("The quick brown fox jumps over the lazy dog while seven wizards quietly mix bright new potions for "
         "kings and queens of distant northern lands")
LONG = " ".join(f"{w}{i % 97}" for i in range(6000) for w in ("alpha", "beta", "gamma"))

# Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose names clash with outputs.
CLASHING = ["id", "kept", "keep_id", "size", "target", "score", "spans", "blob", "n_words", "component_id", "unit",
            "block", "row", "digest", "path", "shard"]
EDGE_ROWS = [
    (1, PROSE, "en", "a", 3),
    (2, PROSE.upper(), "en", "a", 3),
    (3, None, "en", "b", None),
    (4, "", None, "b", 0),
    (5, "   \n\t ", "en", None, 6),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " tail", "en", "b", len(LONG)),
    (8, "x" * 50000, "en", "c", 50000),
    (9, "Mail joe@example.com token = abcdefghijkl0123 \U0001F600 4111 1111 1111 1111", "en", "c", 1),
    (9, "Mail joe@example.com token = abcdefghijkl0123 \U0001F600 4111 1111 1111 1111", "en", "c", 1),
    (9, "another text of the same id, with a few words of its own to stand on", "en", "c", 1),
    (None, "a row without an id has words too, more than ten of them here", "en", None, 1),
    (None, None, None, None, None),
]
