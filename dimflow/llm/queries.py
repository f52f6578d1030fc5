"""The ``opN_`` queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import bpe, clustering, divergence, exact, jaccard, lm, mixing, pii, quality, secret_scan, suffixes
from dimflow.llm import superkmers, wrappers
from dimflow.llm.common import read_table
from dimflow.llm.spans import as_text

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select("doc_id", "__quality.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(read_table(spark, sf_dir, "documents"), digest_all=True)
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                       (F.col("n_removed") > 0).alias("has_repeat"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a growing history: the first up to the middle of the ids, the second over all rows with its ledger."""
    docs = read_table(spark, sf_dir, "documents")
    last = docs.agg(F.max("doc_id")).first()[0]
    _, ledger = secret_scan.scan(docs.where(F.col("doc_id") <= (last or 0) // 2), path_col="doc_id")
    findings, _ = secret_scan.scan(docs, path_col="doc_id", ledger=ledger)
    spans = F.col("spans")
    return findings.select(F.col("path").alias("doc_id"),
                           *[_count(spans, r.name).alias(f"n_{r.name}") for r in secret_scan.RULES],
                           F.sha2(as_text(spans), 256).alias("base_sha256"), as_text(spans).alias("spans"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard.link_classes(read_table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "iban")
    return found.select(F.col("id").alias("doc_id"),
                        *[_count(spans, kind).alias(f"n_{kind}") for kind in pii.KINDS if kind != "iban"],
                        F.sha2(as_text(base), 256).alias("base_sha256"), as_text(spans).alias("spans"),
                        F.size(F.filter(spans, lambda s: s["score"] >= pii.CONFIDENT)).cast("long")
                        .alias("n_confident"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(read_table(spark, sf_dir, "documents"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), TOKENIZER, public_tokenizers.PATTERN)
    return encoded.withColumnRenamed("id", "doc_id")


def op11_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = superkmers.remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256",
                       (F.col("n_removed") > 0).alias("has_repeat"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centres = clustering.cluster(read_table(spark, sf_dir, "embeddings"))
    return clustering.with_inertia(assigned, centres).withColumnRenamed("id", "vec_id")


REGISTRY: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_secret_scan": op5_secret_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_pii": op8_pii,
    "op9_mixing": op9_mixing,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_superkmer_dedup": op11_superkmer_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_centroid_clustering": op13_centroid_clustering,
}
