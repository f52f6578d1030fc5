"""Exact deduplication by progressive refinement, in DataFrame operations only.

Three levels, each reading less than the one before:

1. the byte length of every text, counted; lengths that occur once are settled;
2. for rows of a shared length, a hash of the text's first characters, counted;
3. for rows that share length and prefix hash, the SHA-256 of the whole text.

A level hands its surviving keys to the next as a bitmap of a fixed number of
bits, which is broadcast, so no text is ever shuffled: the full hash is computed
where the row is scanned, and only narrow rows move. A bit hit by two keys only
sends some more rows to the next level; level 3 decides exactly.

Copies of one text may be any share of the table: counting aggregates partially
before its shuffle, and the rows get their group by a join that Spark's adaptive
execution can split, never by collecting a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import ascii_lower, bitmap_of, flag_members, staged, text_of

PREFIX_CHARS = 256
FILTER_BITS = 1 << 23  # 1 MB when broadcast


def _may_repeat(docs: DataFrame, text_col: str, prefix_chars: int, bits: int) -> DataFrame:
    """``docs`` plus ``__candidate``: true for every row whose text occurs twice or more."""
    rows, text = docs, text_of(text_col)
    size_key = F.xxhash64(F.octet_length(text))  # lower-casing A-Z keeps the length
    prefix_key = F.xxhash64(F.octet_length(text), ascii_lower(F.substring(text, 1, prefix_chars)))

    def repeated(frame: DataFrame, key: Column) -> DataFrame:
        return frame.groupBy(key.alias("key")).count().where("count > 1").select("key")

    sizes = bitmap_of(repeated(rows, size_key), bits)
    same_size = flag_members(rows, size_key, sizes, bits, "__sized")
    prefixes = bitmap_of(repeated(same_size.where("__sized"), prefix_key), bits)
    candidates = flag_members(same_size, F.when(F.col("__sized"), prefix_key).otherwise(F.lit(0)), prefixes, bits,
                              "__prefixed")
    return candidates.withColumn("__candidate", F.col("__sized") & F.col("__prefixed")).drop("__sized", "__prefixed")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
                 bits: int = FILTER_BITS, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, digest``.

    Texts are equal when they agree after lower-casing A-Z; null is the empty
    text. Of equal texts the row with the largest id is kept; a null id comes
    before every other, and of rows that repeat the largest id just one is kept.
    ``digest`` (SHA-256 of the normalised text, binary) is null for rows settled
    before level 3, unless ``digest_all`` asks for it.
    """
    rows = _may_repeat(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text")), "__text",
                       prefix_chars, bits)
    digest = F.unhex(F.sha2(ascii_lower(text_of("__text")), 256))
    narrow = staged(rows.select("id", F.monotonically_increasing_id().alias("row"), "__candidate",
                                (digest if digest_all else F.when(F.col("__candidate"), digest)).alias("digest")),
                    "exact_rows")
    alone = narrow.where(~F.col("__candidate")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        "digest")
    several = narrow.where("__candidate")
    # Written first: the join then has a plain exchange on either side, and the partition of a hot text can be split.
    groups = staged(several.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("top"),
                                                  F.count(F.lit(1)).alias("group_size")), "exact_groups")
    members = several.join(groups, "digest").select(
        "id", F.col("top.id").alias("keep_id"), "group_size", (F.col("row") == F.col("top.row")).alias("kept"),
        "digest")
    return alone.unionByName(members)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
             bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` (same columns) with one row left of each text, the one with the largest id.

    Rows settled at level 1 or 2 pass straight through the scan; only rows of
    repeated texts are shuffled, and equal ones collapse before the shuffle.
    """
    columns = docs.columns
    rows = _may_repeat(docs, text_col, prefix_chars, bits)
    row = F.struct(F.col(f"`{id_col}`").alias("__id"), *[F.col(f"`{c}`") for c in columns])
    kept = (rows.where("__candidate").groupBy(F.sha2(ascii_lower(text_of(text_col)), 256).alias("__digest")).agg(F.max(row).alias("__row"))
            .select(*[F.col(f"__row.`{c}`").alias(c) for c in columns]))
    return rows.where(~F.col("__candidate")).select(*[F.col(f"`{c}`") for c in columns]).unionByName(kept)
