"""Positions of regular-expression matches in built-in SQL functions.

Spark's functions return the matches of a pattern, not where they are. The
pieces between the matches (``split`` by the same pattern) and the matches
themselves give the positions: a match starts after all pieces up to it and all
matches before it. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_matches(rows: DataFrame, text: str, pattern: str, may_match: Column, out: str,
                 group: int | None = None, lead: int | None = None) -> DataFrame:
    """``rows`` plus ``out``: an array of structs (start, end, hit[, part][, lead]), leftmost and non-overlapping.

    ``may_match`` is a cheap test that holds for every text with a wanted match;
    the pattern runs over no other text. ``part`` is capture ``group``; ``lead`` ends
    with the ``lead`` characters before the match, or with all there are. It is put
    together from the pieces and matches just before, each of at least a character,
    so what a match costs does not depend on the length of its text.
    """
    none = F.array().cast("array<string>")
    hits, pieces, parts = f"__{out}_hits", f"__{out}_pieces", f"__{out}_parts"
    rows = rows.withColumn(f"__{out}_may", may_match)
    may = F.col(f"__{out}_may")
    rows = rows.withColumn(hits, F.when(may, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
                           .otherwise(none))
    found = F.size(hits) > 0
    rows = rows.withColumn(pieces, F.when(found, F.split(F.col(text), pattern, -1)).otherwise(none))
    if group is not None:
        rows = rows.withColumn(parts, F.when(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group)))
                               .otherwise(none))
    steps = F.zip_with(F.transform(pieces, F.length), F.transform(hits, F.length),
                       lambda gap, size: F.struct(gap.alias("gap"), F.coalesce(size, F.lit(0)).alias("size")))
    start = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"),
                                F.array_append(acc["starts"], acc["at"] + x["gap"]).alias("starts")),
        lambda acc: acc["starts"])
    rows = rows.withColumn(f"__{out}_starts", F.when(found, start).otherwise(F.array().cast("array<int>")))

    def span(hit: Column, i: Column) -> Column:
        at = F.get(f"__{out}_starts", i)
        fields = [at.alias("start"), (at + F.length(hit)).alias("end"), hit.alias("hit")]
        if group is not None:
            fields.append(F.get(parts, i).alias("part"))
        if lead is not None:
            first = F.greatest(i - lead, F.lit(0))
            around = F.zip_with(F.slice(pieces, first + 1, i - first + 1), F.slice(hits, first + 1, i - first),
                                lambda piece, before: F.concat(piece, F.coalesce(before, F.lit(""))))
            fields.append(F.array_join(around, "").alias("lead"))
        return F.struct(*fields)

    rows = rows.withColumn(out, F.transform(hits, span))
    return rows.drop(hits, pieces, f"__{out}_may", f"__{out}_starts", *([parts] if group is not None else []))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of structs with those fields, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")
