"""From raw documents to token ids: five stages, each calling one operator of ``dimflow.llm``.

A stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``docs``; what a stage returns is written as Parquet and read again as the next
one's ``docs``.

``ORACLE_SQL`` is None: SQL can express neither the trained verdict of the first
stage nor the sampling of the fourth; ``tests/llm`` holds each stage against a
plain version instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import bpe, exact, jaccard, mixing, quality
from dimflow.llm.common import read_table, staged

NEAR_WORDS, NEAR_PERCENT = 5, 80  # near duplicates: shingles of five words, similarity of 0.8 or more
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null text fails them. Every row is judged by itself."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return quality.score(docs, model).where("__quality.kept").select(*columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text (A-Z lower-cased, null as empty): the one with the largest id, null ids first."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id, null ids last."""
    return jaccard.keep_one(docs, width=NEAR_WORDS, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often (0 to 2 times) as the mix takes it."""
    return mixing.repeat_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``: the ids as little-endian unsigned 32-bit integers."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return (bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, with_ids=True)
            .withColumnRenamed("id", "doc_id"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline_{i + 1}")
    return docs
