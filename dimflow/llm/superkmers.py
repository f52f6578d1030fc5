"""Removal of long word sequences that occur more than once, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the
``GRAM``-word string of least hash in it, the first of equal ones; equal windows
have equal minimisers at equal distance.

1. Consecutive windows that share a minimiser at one place make a super-k-mer. A
   first pass writes one narrow row for each (minimiser, document, place, number
   of windows), no text. Minimisers that occur once hold no repeat; the others are
   counted with partial aggregation and joined back, hot ones over several tasks.
2. Documents with such super-k-mers meet the list of theirs, and each super-k-mer
   leaves as one packed string (its words, one space between) for the bucket of
   its minimiser. Equal strings are counted before they move, so a group of
   copies, however large, is one string a task.
3. A bucket's windows are sorted and counted exactly, word by word: words become
   numbers by a dictionary, windows rows of numbers. Tasks take buckets a few at a
   time within a fixed memory. A bucket of more than ``BUCKET_BYTES`` (a passage
   with very many different surroundings) is cut further by the same rule, down to
   strings of one window: equal ones again collapse before they move, so no bucket
   is too large for a task.
4. The repeated windows go back to the documents as ranges of words, again with
   hot strings over several tasks. Only documents with repeats are shuffled with
   their text; the rest are hashed where they are read.

Hashes choose buckets only. Strings are told apart by themselves or, where rows
refer to them, by 128 bits of BLAKE2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import bitmap_of, filter_bits, flag_members, ship_package, staged, text_of
from dimflow.llm.hashing import hash_spans, rolling, slices, text_bytes, words
from dimflow.operators.joins import BUCKETS, BUCKETS_PER_TASK, salted_join

WINDOW, GRAM = 35, 12
PLACES = WINDOW - GRAM + 1  # places of a minimiser in its window
CHUNK = 1 << 18  # windows looked at together
BUCKET_BYTES = 4 << 20
HOT_SHARE = 1e-4  # at most 1 / HOT_SHARE hot keys exist

FOUND = "key long, {id} text_key long, at long, n int"
PIECE = "key long, span binary, packed binary"


def minimisers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``WINDOW`` words the place of its minimiser, and the hash of every gram."""
    grams = rolling(hashes, GRAM)
    n = len(hashes) - WINDOW + 1
    place = np.arange(len(grams), dtype=np.uint64)
    keyed = (grams & ~np.uint64(0xFFFFF)) | place  # by the upper 44 bits, then by place
    padded = np.full(-(-len(keyed) // PLACES) * PLACES, ~np.uint64(0), np.uint64)
    padded[:len(keyed)] = keyed
    blocks = padded.reshape(-1, PLACES)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[PLACES - 1:PLACES - 1 + n])
    return (least & np.uint64(0xFFFFF)).astype(np.int64), grams


def super_kmers(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Minimiser hash, text, first window and number of windows of each super-k-mer.

    ``hashes`` are those of the words of all texts, ``first`` the index of each text's first word (with the end).
    """
    for a in range(0, len(hashes) - WINDOW + 1, CHUNK):
        part = hashes[a:a + CHUNK + WINDOW - 1]
        place, grams = minimisers(part)
        at = np.arange(a, a + len(place))
        text = np.searchsorted(first, at, "right") - 1
        whole = at + WINDOW <= first[text + 1]  # windows of one text
        at, text, place = at[whole], text[whole], place[whole]
        if not len(at):
            continue
        fresh = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(text) != 0)]))
        number = np.diff(np.append(fresh, len(at)))
        yield grams[place[fresh]], text[fresh], at[fresh] - first[text[fresh]], number


def _all_super_kmers(texts: DataFrame) -> DataFrame:
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                data, at = text_bytes(part.column(2))
                starts, ends, first = words(data, at)
                for key, text, place, number in super_kmers(hash_spans(data, starts, ends), first):
                    rows = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), part.column(0).take(rows), part.column(1).take(rows),
                         pa.array(place), pa.array(number.astype(np.int32))],
                        names=["key", "id", "text_key", "at", "n"])

    return texts.select("id", "text_key", "text").mapInArrow(run, FOUND.format(id=f"id {id_type},"))


def _spread(big: DataFrame, lookup: DataFrame, on: list[str], counts: DataFrame) -> DataFrame:
    """``big`` joined with ``lookup`` (unique in ``on``); keys that hold a large share of ``big`` go to several tasks.

    ``counts`` holds ``on`` and ``rows``, how many rows of ``big`` have the key.
    """
    spark = big.sparkSession
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    tasks = BUCKETS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = F.greatest(F.col("rows") / F.lit(float(max(1, total))) * F.lit(float(tasks)), F.lit(1.0))
    hot = counts.where(F.col("rows") >= F.lit(HOT_SHARE * total)).where(F.col("rows") > tasks)
    hot = hot.select(*on, F.pow(F.lit(2.0), F.ceil(F.log2(wanted))).cast("int").alias(BUCKETS))
    return salted_join(big, lookup, on, "inner", spark.createDataFrame(hot.collect(), hot.schema), tasks)


def _pieces(subjects: DataFrame, packed: bool) -> DataFrame:
    """Super-k-mers of ``subjects`` (``id, text_key, text, found``) as packed strings or as references to them."""
    id_type = subjects.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                data, at = text_bytes(part.column(2))
                starts, ends, first = words(data, at)
                lists = part.column(3)
                owner, found = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
                place, n = found.field("at").to_numpy(), found.field("n").to_numpy()
                lo = starts[first[owner] + place].tolist()
                hi = ends[first[owner] + place + n + WINDOW - 2].tolist()
                raw = data.tobytes()
                strings = [b" ".join(raw[a:b].split()) for a, b in zip(lo, hi)]
                spans = pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in strings], pa.binary())
                if packed:
                    yield pa.RecordBatch.from_arrays([found.field("key"), spans, pa.array(strings, pa.binary())],
                                                     names=["key", "span", "packed"])
                else:
                    rows = pa.array(owner)
                    yield pa.RecordBatch.from_arrays(
                        [found.field("key"), spans, part.column(0).take(rows), part.column(1).take(rows),
                         found.field("at")], names=["key", "span", "id", "text_key", "at"])

    schema = PIECE if packed else f"key long, span binary, id {id_type}, text_key long, at long"
    return subjects.select("id", "text_key", "text", "found").mapInArrow(run, schema)


def _numbered(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of packed strings as numbers, and how many each string has."""
    split = pc.split_pattern(pa.array(strings, pa.large_binary()), " ")
    return (pc.list_flatten(split).dictionary_encode().indices.to_numpy(),
            pc.list_value_length(split).to_numpy().astype(np.int64))


def repeated_windows(strings: list[bytes], times: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(string, first, number)`` of the runs of windows that occur twice or more; a string occurs ``times`` times."""
    codes, sizes = _numbered(strings)
    windows = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(strings)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (np.cumsum(sizes) - sizes)[owner] + inside
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, WINDOW)[at])
    group = np.unique(rows.view(np.dtype((np.void, rows.strides[0]))).ravel(), return_inverse=True)[1].ravel()
    total = np.zeros(group.max() + 1, np.int64)
    np.add.at(total, group, times[owner])
    hits = np.flatnonzero(total[group] >= 2)
    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(hits) != 1) | (np.diff(owner[hits]) != 0)])[:len(hits)])
    number = np.diff(np.append(fresh, len(hits)))
    return zip(owner[hits[fresh]].tolist(), inside[hits[fresh]].tolist(), number.tolist())


def _sorted_buckets(spans: DataFrame) -> DataFrame:
    """``key, span, first, number`` of repeated windows, over whole buckets (``key, span, packed, times``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            found = list(repeated_windows([h[2] for h in held], np.array([h[3] for h in held], np.int64)))
            return pa.RecordBatch.from_arrays(
                [pa.array([held[i][0] for i, _, _ in found], pa.int64()),
                 pa.array([held[i][1] for i, _, _ in found], pa.binary()),
                 pa.array([a for _, a, _ in found], pa.int64()), pa.array([n for _, _, n in found], pa.int64())],
                names=["key", "span", "first", "number"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= BUCKET_BYTES and row[0] != held[-1][0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield flush()

    return (spans.repartition("key").sortWithinPartitions("key").select("key", "span", "packed", "times")
            .mapInArrow(run, "key long, span binary, first long, number long"))


def _cut_buckets(spans: DataFrame) -> DataFrame:
    """The same for buckets of any size: strings of one window, equal ones counted before they move."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, span, packed, times in zip(*[c.to_pylist() for c in batch.columns]):
                parts = packed.split(b" ")
                n = len(parts) - WINDOW + 1
                windows = [hashlib.blake2b(b" ".join(parts[i:i + WINDOW]), digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.int64()), pa.array([span] * n, pa.binary()), pa.array(np.arange(n)),
                     pa.array(windows, pa.binary()), pa.array([times] * n, pa.int64())],
                    names=["key", "span", "first", "window", "times"])

    windows = (spans.select("key", "span", "packed", "times")
               .mapInArrow(run, "key long, span binary, first long, window binary, times long"))
    counts = staged(windows.groupBy("window").agg(F.sum("times").alias("all"), F.count(F.lit(1)).alias("rows"))
                    .where("all >= 2"), "superkmer_windows")
    often = _spread(windows, counts.select("window"), ["window"], counts.select("window", "rows"))
    return often.select("key", "span", "first", F.lit(1).cast("long").alias("number"))


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """``id, text_key, ranges`` (first window, number of windows) of every text with repeats; texts as ``id, text_key, text``."""
    found = _all_super_kmers(texts)
    shared = staged(found.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows >= 2"), "superkmer_shared")
    kept = _spread(found, shared.select("key"), ["key"], shared)
    lists = staged(kept.distinct().groupBy("id", "text_key")
                   .agg(F.collect_list(F.struct("key", "at", "n")).alias("found")), "superkmer_lists")
    subjects = _with_text(texts, lists, "inner")
    subjects = staged(subjects, "superkmer_subjects")
    spans = staged(_pieces(subjects, packed=True).groupBy("key", "span", "packed")
                   .agg(F.count(F.lit(1)).alias("times")), "superkmer_spans")
    sizes = staged(spans.groupBy("key").agg(F.sum(F.octet_length("packed")).alias("bytes"))
                   .where(F.col("bytes") > BUCKET_BYTES).select("key"), "superkmer_sizes")
    # Keys of large buckets are at most the bytes of all strings over BUCKET_BYTES; Spark chooses how to join them.
    settled = staged(_sorted_buckets(spans.join(sizes, "key", "left_anti"))
                     .unionByName(_cut_buckets(spans.join(sizes, "key", "left_semi"))), "superkmer_repeats")
    # A string's repeats as one row, so that the join below has one row for each string.
    settled = staged(settled.groupBy("key", "span").agg(F.collect_list(F.struct("first", "number")).alias("runs")),
                     "superkmer_runs")
    counts = spans.select("key", "span", F.col("times").alias("rows"))
    hits = _spread(_pieces(subjects, packed=False), settled, ["key", "span"], counts)
    runs = F.transform("runs", lambda r: F.struct((F.col("at") + r["first"]).alias("first"), r["number"].alias("number")))
    return (hits.select("id", "text_key", F.explode(runs).alias("r")).distinct()
            .groupBy("id", "text_key").agg(F.collect_list("r").alias("ranges")))


def _with_text(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts whose key may be among those of ``lists``, joined with their list; only those are shuffled."""
    bits = filter_bits(lists.count())
    flagged = flag_members(texts, F.col("text_key"), bitmap_of(lists.select(F.col("text_key").alias("key")), bits), bits,
                           "__in")
    named = lists.withColumnsRenamed({"id": "__id", "text_key": "__key"})
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    return flagged.where("__in").drop("__in").join(named, same, how).drop("__id", "__key")


def _without(rows: DataFrame) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256, kept`` of rows ``id, text, ranges``."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                data, at = text_bytes(part.column(1))
                starts, ends, first = words(data, at)
                raw, removed, left = data.tobytes(), [], []
                for i, ranges in enumerate(part.column(2).to_pylist()):
                    a, b = int(first[i]), int(first[i + 1])
                    edge = np.zeros(b - a + 1, np.int64)
                    for r in ranges or ():
                        edge[r["first"]] += 1
                        edge[r["first"] + r["number"] + WINDOW - 1] -= 1
                    gone = np.cumsum(edge)[:-1] > 0
                    removed.append(int(gone.sum()))
                    turns = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    left.append(b" ".join(b" ".join(raw[starts[a + x]:ends[a + y - 1]].split())
                                          for x, y in zip(turns[::2].tolist(), turns[1::2].tolist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first).astype(np.int64)), pa.array(removed, pa.int64()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in left]), pa.array(left, pa.binary())],
                    names=["id", "n_words", "n_removed", "kept_sha256", "kept"])

    return rows.select("id", "text", "ranges").mapInArrow(
        run, f"id {id_type}, n_words long, n_removed long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, n_words, n_removed, kept_sha256, kept`` (the words left, one space between).

    Words keep their case. Every word covered by a ``WINDOW``-word sequence that
    also starts anywhere else in the table goes, the same document included;
    sequences are judged on the input. A null text has no words; rows that repeat
    an id, a text or both are repeats of each other; null ids keep their rows; an
    empty table gives no rows. Further columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text"))
    rows = rows.select("id", F.xxhash64("text", F.octet_length("text")).alias("text_key"), "text")
    ranges = staged(repeated_ranges(rows), "superkmer_ranges")
    bits = filter_bits(ranges.count())
    touched = bitmap_of(ranges.select(F.col("text_key").alias("key")), bits)
    none = F.lit(None).cast(ranges.schema["ranges"].dataType)
    clean = flag_members(rows, F.col("text_key"), touched, bits, "__in").where("not __in")
    return _without(clean.select("id", "text", none.alias("ranges"))).unionByName(
        _without(_with_text(rows, ranges, "left").select("id", "text", "ranges")))
