"""Removal of long byte strings that occur more than once, by blockwise suffix sorting.

A suffix matters only by its first ``LENGTH`` bytes. Suffixes are dealt into
buckets by content, and each bucket is sorted by itself:

1. Every suffix has an anchor: of the ``GRAM``-byte strings that lie in its first
   ``LENGTH`` bytes the one of least hash. Equal suffixes have their anchors at
   equal distance. Neighbouring suffixes with one anchor and similar distance
   form a run; the bytes that all of its suffixes must share, its core, are the
   bucket's key. A run is one narrow row: no suffix is shuffled by itself.
2. A bucket with one run holds no repeat. One whose runs all span the same bytes
   is settled by their number. Both are counted with partial aggregation, so
   copies collapse before they move.
3. The other buckets are sorted: suffixes are ordered by their first ``PERIOD``
   bytes, long ties by the rank of the cover sample next in them, then by their
   last ``PERIOD`` bytes. The ranks order all sample positions of the bucket by
   their following ``LENGTH - PERIOD`` bytes and are computed beforehand, so a
   comparison never walks down two long equal strings. Positions are counted
   from the anchor: suffixes that can be equal agree modulo the period, and one
   residue covers every difference that occurs. Neighbours that agree throughout
   are repeats. Buckets are taken a few at a time, within a fixed memory.
4. A bucket of more than ``MOST_SPANS`` different spans is not sorted in one
   task: its suffixes are counted by hash with partial aggregation, which splits
   it without bound.

Only texts that take part in a repeat are moved; they are found by a bitmap of a
fixed number of bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import bitmap_of, flag_members, ship_package, staged, text_of
from dimflow.llm.hashing import hash_of, mix, offsets, prefix_sums, slices

LENGTH, GRAM = 400, 64
WINDOW = LENGTH - GRAM + 1
RUN = -(-WINDOW // 3)  # distances in one run
CORE = LENGTH - RUN + 1
PERIOD = 32
CHUNK = 1 << 19  # suffixes looked at together
MOST_SPANS = 2048
SORT_BYTES = 4 << 20
FILTER_BITS = 1 << 23

RUN_ROW = "core long, span long, text_key long, at long, n int, distance int"


def _anchors(grams: np.ndarray) -> np.ndarray:
    """For every window of ``WINDOW`` hashes the place of its least one (the first of equal ones)."""
    n = len(grams) - WINDOW + 1
    places = np.arange(len(grams), dtype=np.uint64)
    keyed = (grams & ~np.uint64(0xFFFFF)) | places  # by the upper 44 bits, then by place
    padded = np.full(-(-len(keyed) // WINDOW) * WINDOW, ~np.uint64(0), np.uint64)
    padded[:len(keyed)] = keyed
    blocks = padded.reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[WINDOW - 1:WINDOW - 1 + n]) & np.uint64(0xFFFFF)).astype(np.int64)


def runs(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of suffixes of one text: core hash, span hash, first suffix, number, distance of the first to the anchor."""
    for first in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[first:first + CHUNK + LENGTH - 1]
        n = len(part) - LENGTH + 1
        sums = prefix_sums(part)
        at = np.arange(len(part) - GRAM + 1)
        anchor = _anchors(hash_of(sums, at, at + GRAM))
        distance = anchor - np.arange(n)
        third = distance // RUN
        fresh = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(third) != 0)]))
        last = np.append(fresh[1:], n) - 1
        core_at = anchor[fresh] - third[fresh] * RUN
        core = hash_of(sums, core_at, core_at + CORE) + third[fresh].astype(np.uint64)
        span = hash_of(sums, fresh, last + LENGTH) ^ mix(distance[fresh].astype(np.uint64) + np.uint64(7))
        yield core, span, first + fresh, last - fresh + 1, distance[fresh]


def _all_runs(texts: DataFrame) -> DataFrame:
    """``RUN_ROW`` of every run of every text (``text_key, text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found: list[list[np.ndarray]] = [[] for _ in range(6)]
                at, raw = offsets(part.column(1)), np.frombuffer(part.column(1).buffers()[2] or b"", np.uint8)
                for key, a, b in zip(part.column(0).to_pylist(), at, at[1:]):
                    for core, span, start, n, distance in runs(raw[a:b]):
                        for column, values in zip(found, (core.view(np.int64), span.view(np.int64),
                                                          np.full(len(core), key, np.int64), start,
                                                          n.astype(np.int32), distance.astype(np.int32))):
                            column.append(values)
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found],
                                                     names=["core", "span", "text_key", "at", "n", "distance"])

    return texts.select("text_key", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(run, RUN_ROW)


def _cut(rows: DataFrame) -> DataFrame:
    """``core, span, distance, times, bytes`` of the spans listed beside each text (``text, spans``)."""
    names = ["core", "span", "distance", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                texts, lists = part.column(0), part.column(1)
                at, raw = offsets(texts), texts.buffers()[2].to_pybytes()
                owner, found = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
                first = at[owner] + found.field("at").to_numpy()
                last = first + found.field("n").to_numpy() + LENGTH - 1
                pieces = [raw[a:b] for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays([*[found.field(x) for x in names], pa.array(pieces, pa.binary())],
                                                 names=[*names, "bytes"])

    return rows.mapInArrow(run, "core long, span long, distance int, times long, bytes binary")


def _without(rows: DataFrame) -> DataFrame:
    """Rows ``id, text, ranges`` (sorted, may overlap) as ``id, n_bytes, n_removed, n_spans, kept_sha256, kept``."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                at, buffer = offsets(part.column(1)), part.column(1).buffers()[2]
                raw = buffer.to_pybytes() if buffer is not None else b""
                sizes, removed, runs, left = [], [], [], []
                for a, b, ranges in zip(at.tolist(), at[1:].tolist(), part.column(2).to_pylist()):
                    pieces, to, gone, n = [], a, 0, 0
                    for r in ranges or ():
                        start, end = a + r["start"], a + r["end"]
                        n += not n or start > to  # a range that touches the one before belongs to its run
                        if start > to or not gone:
                            pieces.append(raw[to:start])
                        gone += max(0, end - max(start, to))
                        to = max(to, end)
                    kept = b"".join([*pieces, raw[to:b]])
                    for column, value in zip((sizes, removed, runs, left), (b - a, gone, n, kept)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in (sizes, removed, runs)],
                     pa.array([hashlib.sha256(k).hexdigest() for k in left], pa.string()), pa.array(left, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.select("id", "text", "ranges").mapInArrow(
        run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _windows(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """``data[i:i + width]`` of every ``i``, as values that compare like the bytes."""
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[at]
    return np.ascontiguousarray(rows).view(np.dtype((np.void, width))).ravel()


def sort_buckets(cores: np.ndarray, spans: list[bytes], distances: np.ndarray, times: np.ndarray
                 ) -> Iterator[tuple[int, int, int]]:
    """``(span, first, number)`` of the runs of repeated suffixes, over whole buckets.

    ``cores`` numbers the bucket of each span, ``distances`` is how far each
    span's first suffix is from the anchor, ``times`` how often the span occurs.
    """
    data = np.frombuffer(b"".join(spans), np.uint8)
    sizes = np.array([len(s) for s in spans])
    base = np.cumsum(sizes) - sizes
    n = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(spans)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = base[owner] + inside
    distance = distances[owner] - inside
    # Cover sample: positions whose distance to the anchor is a multiple of the period, ranked by what follows them.
    skip = distance % PERIOD
    sample, where = np.unique(at + skip, return_inverse=True)
    ranks = np.unique(_windows(data, sample, LENGTH - PERIOD), return_inverse=True)[1].ravel()[where]
    heads = np.unique(_windows(data, at, PERIOD), return_inverse=True)[1].ravel()
    tails = np.unique(_windows(data, at + LENGTH - PERIOD, PERIOD), return_inverse=True)[1].ravel()
    bucket = cores[owner]
    order = np.lexsort((tails, ranks, heads, distance, bucket))
    same = np.ones(len(order), bool)
    for key in (tails, ranks, heads, distance, bucket):
        key = key[order]
        same[1:] &= key[1:] == key[:-1]
    same[0] = False
    group = np.cumsum(~same) - 1
    often = np.bincount(group, times[owner[order]])
    repeated = np.zeros(len(order), bool)
    repeated[order] = often[group] >= 2
    # runs of repeated suffixes, cut where a span ends
    breaks = np.flatnonzero(np.diff(owner)) + 1
    marks = np.zeros(len(owner) + 1, bool)
    marks[breaks] = True
    starts = np.flatnonzero(repeated & np.concatenate([[True], ~repeated[:-1] | marks[1:-1]]))
    ends = np.flatnonzero(repeated & np.concatenate([~repeated[1:] | marks[1:-1], [True]])) + 1
    for a, b in zip(starts, ends):
        yield int(owner[a]), int(inside[a]), int(b - a)


def _sorted_buckets(spans: DataFrame) -> DataFrame:
    """``core, span, first, number`` of repeated suffixes in buckets that fit a task (``core, span, distance, times, bytes``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            cores = np.unique(np.array([h[0] for h in held]), return_inverse=True)[1]
            found = list(sort_buckets(cores, [h[4] for h in held], np.array([h[2] for h in held]),
                                      np.array([h[3] for h in held])))
            return pa.RecordBatch.from_arrays(
                [pa.array([held[i][0] for i, _, _ in found], pa.int64()),
                 pa.array([held[i][1] for i, _, _ in found], pa.int64()),
                 pa.array([a for _, a, _ in found], pa.int32()), pa.array([n for _, _, n in found], pa.int32())],
                names=["core", "span", "first", "number"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= SORT_BYTES and row[0] != held[-1][0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield flush()

    return (spans.repartition("core").sortWithinPartitions("core").select("core", "span", "distance", "times", "bytes")
            .mapInArrow(run, "core long, span long, first int, number int"))


def _counted_buckets(spans: DataFrame) -> DataFrame:
    """The same for buckets of any size: every suffix is a row, counted by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for core, span, distance, times, data in zip(*[c.to_pylist() for c in batch.columns]):
                data = np.frombuffer(data, np.uint8)
                at = np.arange(len(data) - LENGTH + 1)
                suffix = hash_of(prefix_sums(data), at, at + LENGTH) + (distance - at).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), core)), pa.array(np.full(len(at), span)), pa.array(at.astype(np.int32)),
                     pa.array(suffix.view(np.int64)),
                     pa.array(np.full(len(at), times))], names=["core", "span", "first", "suffix", "times"])

    suffixes = (spans.select("core", "span", "distance", "times", "bytes")
                .mapInArrow(run, "core long, span long, first int, suffix long, times long"))
    often = staged(suffixes.groupBy("core", "suffix").agg(F.sum("times").alias("all")).where("all >= 2")
                   .select("core", "suffix"), "suffix_counts")
    return (suffixes.join(often, ["core", "suffix"]).select("core", "span", "first", F.lit(1).alias("number")))


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """``text_key, ranges``: byte ranges (start, end) to remove, of every text that has any; texts as ``text_key, text``."""
    found = _all_runs(texts)
    shared = staged(found.groupBy("core").agg(F.count(F.lit(1)).alias("__n"), F.min("span").alias("lo"),
                                              F.max("span").alias("hi"))
                    .where("__n >= 2").select("core", (F.col("lo") != F.col("hi")).alias("mixed")), "suffix_cores")
    kept = staged(found.join(shared, "core"), "suffix_runs")
    whole = kept.where("not mixed").select("text_key", F.col("at").alias("first"), F.col("n").alias("number"))

    mixed = kept.where("mixed")
    spans = staged(mixed.groupBy("core", "span").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("text_key", "at", "n", "distance")).alias("one"))
        .select("core", "span", "times", "one.*"), "suffix_spans")
    wanted = bitmap_of(spans.select(F.col("text_key").alias("key")), FILTER_BITS)
    sources = (flag_members(texts.select("text_key", "text"), F.col("text_key"), wanted, FILTER_BITS, "__in")
               .where("__in").select("text_key", "text").dropDuplicates(["text_key"]))
    # All spans of a text are cut from one copy of it.
    lists = spans.groupBy("text_key").agg(F.collect_list(F.struct("core", "span", "distance", "times", "at", "n"))
                                          .alias("spans"))
    full = staged(_cut(lists.join(sources, "text_key").select("text", "spans")), "suffix_bytes")
    sizes = staged(full.groupBy("core").agg((F.count(F.lit(1)) > MOST_SPANS).alias("large")), "suffix_sizes")
    sized = full.join(sizes, "core")
    settled = _sorted_buckets(sized.where("not large")).unionByName(_counted_buckets(sized.where("large")))
    settled = staged(settled, "suffix_repeats")
    parts = (mixed.select("core", "span", "text_key", "at").join(settled, ["core", "span"])
             .select("text_key", (F.col("at") + F.col("first")).alias("first"), "number"))
    ranges = F.struct(F.col("first").alias("start"), (F.col("first") + F.col("number") + LENGTH - 1).alias("end"))
    pieces = whole.unionByName(parts).select("text_key", ranges.alias("r")).distinct()
    return pieces.groupBy("text_key").agg(F.array_sort(F.collect_list("r")).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left).

    Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
    in the table goes; ranges are judged on the input. A null text is the empty
    text. Rows that repeat a text, with the same id or another, are repeats of
    each other; null ids keep their rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text", F.octet_length("text")))
    ranges = staged(repeated_ranges(rows), "suffix_ranges")
    touched = bitmap_of(ranges.select(F.col("text_key").alias("key")), FILTER_BITS)
    flagged = flag_members(rows, F.col("text_key"), touched, FILTER_BITS, "__in")
    clean = flagged.where("not __in").select("id", F.encode("text", "UTF-8").alias("kept"))
    zero = F.lit(0).cast("long")
    clean = clean.select("id", F.octet_length("kept").cast("long").alias("n_bytes"), zero.alias("n_removed"),
                         zero.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "kept")
    return clean.unionByName(_without(flagged.where("__in").join(ranges, "text_key", "left")))
