"""Source divergence audit: how far the term distributions of a language's sources lie from each other.

Counting is an Arrow compute pipeline inside ``mapInArrow``: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and a hash ``group_by`` turn a run
of texts into partial counts, one row for each language, source and term with its
occurrences and documents; a task merges the partial counts of its runs up to a
bounded size before it sends them on, and Spark merges them by exact term. No
text moves, and a language or source of any size is only as many rows as it has
terms.

The merged counts of kept terms are dealt into shards by language and hash of the
term, about ``SHARD_ROWS`` rows each, so the largest language is many tasks. A
shard makes a column of smoothed shares for each source of the language, in blocks
of a bounded number of cells, and adds up the divergences of all ordered pairs of
sources over its terms; Spark adds the shards. The reported terms are the best
``TOP`` of each shard, then the best ``TOP`` of those. All arithmetic is on
integers, so nothing depends on order, partitioning or retries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.common import ship_package, staged, text_of
from dimflow.llm.hashing import slices

# What separates terms, the least number of documents of a kept term, the scale of shares, the ranks shown.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
SCALE_STEPS = (1000, 1000, 1000)  # the scale, 10^9, in factors that keep exact long division inside 64 bits
TOP = 200

SLICE = 4 << 20  # bytes of text split together
HELD_ROWS = 1 << 18  # partial counts that a task holds before it sends them
SHARD_ROWS = 1 << 17
CELLS = 1 << 20  # terms x sources looked at together

COUNTS = "lang string, source string, term string, n long, docs long"
FOUND = "lang string, source string, part string, item string, value long"


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, n, docs`` of texts (``lang, source, text``, none null)."""
    split = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), SEPARATORS)
    terms, rows = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.greater(pc.binary_length(terms), 0)
    coded = terms.filter(filled).dictionary_encode()
    langs, sources = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
    _, first, group = np.unique(langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary)
                                + sources.indices.to_numpy(), return_index=True, return_inverse=True)
    by_row = pa.table({"row": rows.filter(filled), "term": coded.indices}).group_by(["row", "term"]).aggregate(
        [([], "count_all")])
    by_group = (pa.table({"group": pa.array(group).take(by_row["row"]), "term": by_row["term"], "n": by_row["count_all"]})
                .group_by(["group", "term"]).aggregate([("n", "sum"), ([], "count_all")]))
    of_group = pa.array(first).take(by_group["group"].combine_chunks())  # one row of each group
    return pa.table({"lang": batch.column(0).take(of_group), "source": batch.column(1).take(of_group),
                     "term": coded.dictionary.take(by_group["term"].combine_chunks()),
                     "n": by_group["n_sum"], "docs": by_group["count_all"]})


def merged(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables)
    if len(tables) == 1:
        return table
    added = table.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return added.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(table.column_names)


def partial_counts(docs: DataFrame) -> DataFrame:
    """``COUNTS`` of every language, source and term, summed; ``docs`` as ``lang, source, text`` without nulls."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        fresh = 0
        for batch in batches:
            for part in slices(batch, 2, SLICE):
                held.append(count_terms(part))
                fresh += len(held[-1])
                if fresh >= HELD_ROWS:
                    held = [merged(held)]
                    if len(held[0]) >= HELD_ROWS:
                        yield from held.pop().to_batches()
                    fresh = 0
        if held:
            yield from merged(held).to_batches()

    return docs.select("lang", "source", "text").mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``1 + floor(10^9 * (count + 1) / total)``, exact; a total is a group's occurrences and the number of kept terms."""
    whole, rest = np.divmod(counts + 1, totals)
    for step in SCALE_STEPS:
        more, rest = np.divmod(rest * step, totals)
        whole = whole * step + more
    return whole + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / q)``."""
    return np.square(p - q) // q


def _shard(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of pairs and best terms of one shard.

    ``terms``: lang, shard, source, term, n, lang_n. ``groups``: lang, shard, source, occurrences,
    lang_occurrences, kept_terms of every source of the language.
    """
    out: dict[str, list] = {"lang": [], "source": [], "part": [], "item": [], "value": []}
    sources = groups.column("source").to_pylist()
    if len(groups):
        kept = groups.column("kept_terms")[0].as_py()
        totals = groups.column("occurrences").to_numpy() + kept
        lang, lang_total = groups.column("lang")[0].as_py(), groups.column("lang_occurrences")[0].as_py() + kept
        coded = terms.column("term").combine_chunks().dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy()
        number = {s: i for i, s in enumerate(sources)}
        owner = np.array([number[s] for s in terms.column("source").to_pylist()], np.int64)
        n = terms.column("n").to_numpy()
        order = np.argsort(codes, kind="stable")
        lang_n = np.zeros(len(names), np.int64)
        lang_n[codes] = terms.column("lang_n").to_numpy()
        sums = np.zeros((len(sources), len(sources)), np.int64)
        best: list[list[tuple[int, bytes]]] = [[] for _ in sources]
        step = max(1, CELLS // max(1, len(sources)))
        for a in range(0, len(names), step):
            b = min(len(names), a + step)
            lo, hi = np.searchsorted(codes[order], [a, b])
            rows = order[lo:hi]
            counts = np.zeros((len(sources), b - a), np.int64)
            counts[owner[rows], codes[rows] - a] = n[rows]
            p = shares(counts, totals[:, None])
            q = shares(lang_n[a:b], lang_total)
            for g in range(len(sources)):
                sums[g] += apart(p[g], p).sum(1)
                more = np.flatnonzero((counts[g] > 0) & (p[g] > q))
                value = apart(p[g, more], q[more])
                if len(more) > TOP:  # all that tie with the last one shown stay for now
                    more, value = (x[value >= np.partition(value, len(value) - TOP)[-TOP]] for x in (more, value))
                found = zip(value.tolist(), names.take(pa.array(more + a)).to_pylist())
                best[g] = sorted([*best[g], *((-v, t.encode()) for v, t in found)])[:TOP]
        for g, source in enumerate(sources):
            rows = [("pair", other, int(v)) for h, (other, v) in enumerate(zip(sources, sums[g])) if h != g]
            rows += [("term", t.decode(), -v) for v, t in best[g]]
            for part, item, value in rows:
                for name, x in zip(out, (lang, source, part, item, value)):
                    out[name].append(x)
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: every other source of the language, and the terms a source has more of.

    Null text, language and source are the empty string. Terms are runs of
    letters A-Z and characters beyond ASCII, A-Z lower-cased; a language keeps
    those in at least three of its rows (repeated rows and ids count each). A
    language without kept terms has value 0 for all pairs and no terms; a language
    of one source has no pairs; an empty table has no rows. Ties go by the item's
    UTF-8 bytes. Further columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(text_of(f"`{lang_col}`").alias("lang"), text_of(f"`{source_col}`").alias("source"),
                       text_of(f"`{text_col}`").alias("text"))
    counts = staged(partial_counts(rows), "divergence_counts")
    kept = staged(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                  .where(F.col("docs") >= LEAST_DOCUMENTS).select("lang", "term", "lang_n"), "divergence_kept")
    found = staged(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"),
                   "divergence_found")
    # One row for each source: rows of a language are at most its sources.
    groups = rows.select("lang", "source").distinct()
    held = found.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_occurrences"), F.count(F.lit(1)).alias("kept_terms"))
    zero = F.lit(0).cast("long")
    groups = staged(groups.join(held, ["lang", "source"], "left").join(langs, "lang", "left")
                    .select("lang", "source", F.coalesce("occurrences", zero).alias("occurrences"),
                            F.coalesce("lang_occurrences", zero).alias("lang_occurrences"),
                            F.coalesce("kept_terms", zero).alias("kept_terms")), "divergence_groups")
    shards = max(1, -(-found.count() // SHARD_ROWS))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    used = dealt.select("lang", "shard").distinct()  # each language's sources go where it has terms
    everywhere = groups.join(used, "lang", "left").withColumn("shard", F.coalesce("shard", F.lit(0)))
    sums = dealt.groupBy("lang", "shard").cogroup(everywhere.groupBy("lang", "shard")).applyInArrow(_shard, FOUND)
    total = staged(sums, "divergence_sums")
    pairs = (total.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(_ranks())))
    terms = total.where("part = 'term'").withColumn("rank", F.row_number().over(_ranks())).where(F.col("rank") <= TOP)
    return pairs.unionByName(terms)


def _ranks() -> Window:
    return Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
