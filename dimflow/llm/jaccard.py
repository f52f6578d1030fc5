"""Jaccard join of word n-gram sets by a grouped prefix join, and the classes its links make.

Two sets of similarity t or more share one of the first ``n - ceil(t n) + 1``
shingles of either in any one order of all shingles. The order puts rare
shingles first: by counts in a table of a fixed number of cells that covers the
whole corpus, then by hash. Boilerplate is thus kept out of the prefixes.

* Documents with the same set are one class, classes with the same prefix and
  size one group: only groups meet in the join.
* Group pairs are filtered by size, and by position: what stands before their
  first common shingle in either prefix is in one of the sets only.
* The groups left are expanded to their classes, whose whole sets are compared.

A shingle shared by many groups would make pairs by the square of their number.
So the join runs twice. First every group meets one hub for each shingle, which
settles most members of a large family of near copies. Then the pairs that are
still in different components meet; none of these is left out. Shingles of more
than ``HOT`` groups make no rows of pairs even then: their groups gather in
families by hub, as do the classes of two groups of many.

* A family whose sets are all in one component is done. In any other, the sets
  outside its largest component are its rest; only pairs with one of the rest
  can make a new link.
* While a rest has more than ``BLOCK`` sets, one of it meets the whole family, up
  to ``HUB_ROUNDS`` times and for as long as that finds links, and the components
  that the links name are joined.
* Blocks of the rest are then compared with the blocks of the family in memory,
  at most two times ``BLOCK`` sets at a time. A rest of one block copies each set
  of its family once or twice, however large the family is.
* Pairs of blocks meet in turns: a block with ``BAND`` others first, then with
  ``BAND`` times as many in each turn, until it has met all. A pair of blocks
  reports only links between components that were apart before its turn, so
  their number grows with the family, not with the number of pairs of blocks.
  Pairs whose sets are all of the family's largest component are left out.

Intermediate tables are written by one task for each ``DOCS`` documents at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import BITS_PER_CHUNK, bitmap_of, bound_batches, flag_members, ship_package, staged, text_of
from dimflow.llm.components import components
from dimflow.llm.hashing import PART_BYTES, mix, rolling, slices, word_hashes

SHINGLE, THRESHOLD = 4, 85  # words; percent
CELLS, CHUNKS = 1 << 22, 64
FAN_IN = 64
FILTER_BITS = 1 << 23
HOT, BLOCK = 64, 512
HUB_ROUNDS = 4
BAND = 4
DOCS = 1 << 14


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, ascending; one of the whole sequence for texts of fewer words."""
    hashes, first = word_hashes(texts)
    grams = rolling(hashes, width)
    for a, b in zip(first, first[1:]):
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:
            yield mix(rolling(hashes[a:b], int(b - a)) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)) % np.uint64(CELLS)


def add_sets(cells: np.ndarray, sets: list[np.ndarray]) -> None:
    """Count the shingles of ``sets`` in ``cells``, in place: no second table of ``CELLS``."""
    np.add.at(cells, _cell(np.concatenate(sets)), np.uint32(1))


def frequencies(texts: DataFrame, width: int) -> np.ndarray:
    """How many sets of the whole corpus fall in each of ``CELLS`` cells by their shingles."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for part in slices(batch, 0, PART_BYTES):
                add_sets(cells, list(shingle_sets(part.column(0), width)))
        if cells.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * CHUNKS, pa.int64()),
                 pa.array(range(CHUNKS), pa.int64()),
                 pa.array([zlib.compress(c.tobytes(), 1) for c in np.split(cells, CHUNKS)], pa.binary())],
                names=["task", "chunk", "cells"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // CHUNKS, np.uint64)
        for cells in group.column("cells"):
            total += np.frombuffer(zlib.decompress(cells.as_py()), np.uint32)
        packed = np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()
        return pa.table({"task": group.column("task")[:1], "chunk": group.column("chunk")[:1],
                         "cells": pa.array([zlib.compress(packed, 1)], pa.binary())})

    schema = "task long, chunk long, cells binary"
    parts = texts.mapInArrow(count, schema)
    for task in [F.floor(F.col("task") / FAN_IN)] * 2 + [F.lit(0).cast("long")]:  # FAN_IN at a time
        parts = parts.withColumn("task", task).groupBy("task", "chunk").applyInArrow(add, schema)
    cells = np.zeros(CELLS, np.uint32)
    for row in parts.collect():  # CHUNKS rows of a fixed size
        size = CELLS // CHUNKS
        cells[row["chunk"] * size:(row["chunk"] + 1) * size] = np.frombuffer(zlib.decompress(row["cells"]), np.uint32)
    return cells


def _signatures(rows: DataFrame, cells: np.ndarray, width: int, percent: int) -> DataFrame:
    """``id, text_key, n, set_key, group_key, prefix`` of every document; keys are sums of mixed hashes over set and prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)  # of a fixed size
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                sizes, set_keys, group_keys, prefixes = [], [], [], []
                for found in shingle_sets(part.column(1), width):
                    n = len(found)
                    keep = prefix_length(n, percent) if n else 0
                    order = np.argsort(often[_cell(found)], kind="stable")[:keep]  # ties stay in order of hash
                    prefix = found[order]
                    sizes.append(n)
                    set_keys.append(int(_key(found)))
                    group_keys.append(int(_key(prefix)))
                    prefixes.append(prefix.view(np.int64))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)),
                    pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(set_keys, pa.int64()),
                     pa.array(group_keys, pa.int64()), lists],
                    names=["id", "text_key", "n", "set_key", "group_key", "prefix"])

    return rows.mapInArrow(run, f"id {id_type}, text_key long, n long, set_key long, group_key long, "
                                "prefix array<long>")


def _key(shingles: np.ndarray) -> np.int64:
    """One number for a set of shingles and its size."""
    total = mix(shingles + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return mix(np.array([total], np.uint64)).view(np.int64)[0]


def _may_link(n1: Column, n2: Column, before: Column, percent: int) -> Column:
    """Sizes are near enough, and ``before`` shingles known to be in one set only leave enough in common."""
    least_common = F.ceil((n1 + n2) * percent / F.lit(100 + percent))
    return ((F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (before <= n1 + n2 - least_common * 2))


def _group_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct ``g1, g2`` of rows of common shingles (``g1, g2, n1, n2, p1, p2``) that may link.

    In either prefix, what stands up to the last common shingle and is not common
    is in one set only; so is the rest of the prefix that ends first.
    """
    def after(n: str, last: str) -> Column:
        return F.col(n) - F.ceil(F.col(n) * percent / F.lit(100)) - F.col(last)
    pairs = rows.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("c"), F.max("p1").alias("m1"), F.max("p2").alias("m2"),
                                         F.first("n1").alias("n1"), F.first("n2").alias("n2"))
    apart = F.col("m1") + F.col("m2") + 2 - F.col("c") * 2 + F.least(after("n1", "m1"), after("n2", "m2"))
    return pairs.where(_may_link(F.col("n1"), F.col("n2"), apart, percent)).select("g1", "g2")


def _sets(keys: DataFrame, rows: DataFrame, width: int, tasks: int) -> DataFrame:
    """``key, shingles`` (sorted, packed) of the wanted set keys (``key``) and perhaps a few more, from the texts."""
    bitmap = np.zeros(FILTER_BITS, bool)
    for row in bitmap_of(keys, FILTER_BITS).collect():  # at most FILTER_BITS / 8 bytes
        bits = np.unpackbits(np.frombuffer(row["__bitmap"], np.uint8), bitorder="little").astype(bool)
        at = (row["__chunk"] - 1) * BITS_PER_CHUNK
        bitmap[at:at + BITS_PER_CHUNK] = bits
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for part in slices(batch, 0, PART_BYTES):
                found_keys, packed = [], []
                for found in shingle_sets(part.column(0), width):
                    if len(found) and member[(key := int(_key(found))) % FILTER_BITS]:
                        found_keys.append(key)
                        packed.append(found.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(found_keys, pa.int64()), pa.array(packed, pa.binary())],
                                                 names=["key", "shingles"])

    return staged(rows.select("text").mapInArrow(run, "key long, shingles binary").groupBy("key")
                  .agg(F.first("shingles").alias("shingles")), "jaccard_sets", tasks)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Pairs ``a, b`` of set keys whose whole sets link: ``100 * common >= percent * united``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)],
                                             names=["a", "b"])

    full = (pairs.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("of_b")), "b")
            .join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("of_a")), "a"))
    return staged(full.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long"), "jaccard_links", tasks)


def _between(links: DataFrame, rooted: DataFrame, tasks: int) -> DataFrame:
    """Links ``a, b`` of sets as edges between the components (``set_key, root``) that they join."""
    one, two = (rooted.select(F.col("set_key").alias(end), F.col("root").alias(f"root_{end}")) for end in "ab")
    ends = links.join(one, "a").join(two, "b").where("root_a <> root_b")
    return staged(ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "jaccard_joins", tasks)


def _joined(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the new ``root`` of each old one (``node, root``; the same where it has none)."""
    new = roots.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    columns = [F.coalesce("new_root", "root").alias("root") if c == "root" else F.col(c) for c in rows.columns]
    return rows.join(new, "root", "left").select(*columns)


def link_block(keys: list[int], roots: list[int], sets: list[np.ndarray], first: np.ndarray, second: np.ndarray,
               percent: int) -> list[tuple[int, int]]:
    """Links between the sets marked ``first`` and those marked ``second`` that join components not joined before."""
    sizes = np.array([len(x) for x in sets])
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    up = {r: r for r in roots}

    def find(r: int) -> int:
        while up[r] != r:
            up[r] = up[up[r]]
            r = up[r]
        return r

    out = []
    for i in np.flatnonzero(first):
        starts = np.searchsorted(shingles, sets[i], "left")
        lengths = np.searchsorted(shingles, sets[i], "right") - starts
        places = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[places], minlength=len(sets))
        linked = second & (100 * common >= percent * (sizes[i] + sizes - common))
        for j in np.flatnonzero(linked):
            a, b = find(roots[i]), find(roots[j])
            if a != b:
                up[a] = b
                out.append((keys[i], keys[j]))
    return out


def _with_rest(families: DataFrame, tasks: int | None = None) -> DataFrame:
    """``hub, set_key, root, rest, n_rest, n_major`` of the families (``hub, set_key, root``) of several components.

    The rest of a family are its sets outside its largest component. Sizes are counted before they move.
    """
    counted = families.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("c"))
    sizes = staged(counted.groupBy("hub").agg(F.max(F.struct("c", "root")).alias("major"), F.sum("c").alias("size"))
                   .where(F.col("major.c") < F.col("size"))
                   .select("hub", F.col("major.root").alias("major"), F.col("major.c").alias("n_major"),
                           (F.col("size") - F.col("major.c")).alias("n_rest")), "jaccard_family_sizes", tasks)
    return staged(families.join(sizes, "hub").select("hub", "set_key", "root", (F.col("root") != F.col("major"))
                                                     .alias("rest"), "n_rest", "n_major"), "jaccard_open_families", tasks)


def _next_hubs(families: DataFrame, turn: int = 0, tasks: int | None = None) -> DataFrame:
    """Pairs ``a, b``: one set of each rest of more than ``BLOCK``, and every set of its family in another component."""
    draw = F.struct(F.xxhash64("set_key", F.lit(turn)).alias("draw"), F.col("set_key").alias("b"), F.col("root").alias("of"))
    wide = families.where(F.col("n_rest") > BLOCK)
    hubs = staged(wide.where("rest").groupBy("hub").agg(F.min(draw).alias("h")).select("hub", "h.b", "h.of"),
                  "jaccard_next_hubs", tasks)
    return wide.join(hubs, "hub").where("root <> of").select(F.col("set_key").alias("a"), "b").distinct()


def _blocks(size: str) -> Column:
    return F.ceil(F.col(size) / F.lit(BLOCK))


def _numbered(families: DataFrame) -> DataFrame:
    """``families`` with the number ``own`` of each set's block: the rest's blocks come first."""
    deal = F.xxhash64("set_key")
    return families.withColumn("own", F.when(F.col("rest"), F.pmod(deal, _blocks("n_rest"))).otherwise(
        _blocks("n_rest") + F.pmod(deal, _blocks("n_major"))))


def _dealt(families: DataFrame) -> DataFrame:
    """``hub, set_key, root, own, one, two``: every set of a family for each pair of blocks (one, two) that it meets in.

    The rest's blocks come first; a pair has one of them at least.
    """
    numbered = _numbered(families)
    return _met(numbered, _block_pairs(numbered))


def _block_pairs(numbered: DataFrame, start: int = 0, end: int | None = None, still: DataFrame | None = None) -> DataFrame:
    """Pairs ``hub, one, two`` (one <= two) of blocks, one of the rest's at least, that are ``start`` to ``end`` - 1 apart.

    Blocks of the rest are as far apart as their numbers. From one of the rest to those of the largest component it is
    counted around the circle of the latter, so that each turn has as many for every block. ``still``: the blocks
    (``hub, own``) one of which is in each pair.
    """
    sizes = numbered.select("hub", _blocks("n_rest").alias("r"), _blocks("n_major").alias("m")).distinct()
    ones = sizes.withColumn("one", F.explode(F.sequence(F.lit(0).cast("long"), F.col("r") - 1)))

    def steps(most: Column) -> Column:
        last = most - 1 if end is None else F.least(most - 1, F.lit(end - 1).cast("long"))
        return F.when(last >= start, F.sequence(F.lit(start).cast("long"), last)).otherwise(F.array().cast("array<long>"))
    among = F.transform(steps(F.col("r") - F.col("one")), lambda d: F.col("one") + d)
    beyond = F.transform(steps(F.col("m")), lambda d: F.col("r") + F.pmod(F.col("one") + d, F.col("m")))
    pairs = ones.select("hub", "one", F.explode(F.concat(among, beyond)).alias("two"))
    if still is None:
        return pairs
    marks = [still.select("hub", F.col("own").alias(x), F.lit(True).alias(f"open_{x}")) for x in ("one", "two")]
    return (pairs.join(marks[0], ["hub", "one"], "left").join(marks[1], ["hub", "two"], "left")
            .where("open_one or open_two").select("hub", "one", "two"))


def _met(numbered: DataFrame, pairs: DataFrame) -> DataFrame:
    """``hub, set_key, root, own, one, two``: every set for each of the pairs that its block is in."""
    own = pairs.select("hub", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("own"))
    return numbered.join(own, ["hub", "own"]).select("hub", "set_key", "root", "own", "one", "two")


def _linked_families(met: DataFrame, sets: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Links ``a, b`` that join components, of the sets that meet in pairs of blocks (see :func:`_dealt`)."""
    full = met.join(sets.withColumnRenamed("key", "set_key"), "set_key")

    def run(group: pa.Table) -> pa.Table:
        own, one = np.array(group.column("own")), group.column("one")[0].as_py()
        two = group.column("two")[0].as_py()
        found = link_block(group.column("set_key").to_pylist(), group.column("root").to_pylist(),
                           [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")],
                           own == one, own == two, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    found = full.groupBy("hub", "one", "two").applyInArrow(run, "a long, b long")
    return staged(found, "jaccard_family_links", tasks)


def _family_joins(rests: DataFrame, joins: DataFrame, sets: DataFrame, percent: int, rooted: DataFrame, tasks: int
                  ) -> DataFrame:
    """``joins`` with the edges between components that the blocks of the rests (:func:`_with_rest`) find, turn by turn."""
    start, end = 0, BAND
    most = rests.agg(F.max(F.greatest(_blocks("n_rest"), _blocks("n_major")))).first()[0] or 0  # blocks in a circle
    numbered = staged(_numbered(rests), "jaccard_blocks", tasks) if most else rests
    still = None
    while start < most:
        pairs = _block_pairs(numbered, start, end, still)
        links = _linked_families(_met(numbered, pairs), sets, percent, tasks)
        found = _between(links, rooted, tasks)
        start, end = end, end * BAND
        joins = joins.unionByName(found)
        if start < most:
            roots = staged(components(joins), "jaccard_roots", tasks)
            joins = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b")
            numbered = staged(_joined(numbered, roots), "jaccard_blocks", tasks)
            counted = numbered.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("c"))
            largest = counted.groupBy("hub").agg(F.max(F.struct("c", "root")).alias("most")).select("hub", "most.root")
            still = staged(numbered.join(largest.withColumnRenamed("root", "largest"), "hub")
                           .where("root <> largest").select("hub", "own").distinct(), "jaccard_still", tasks)
            if still.isEmpty():
                break
    return joins


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                 percent: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id, n_shingles, component_id, text_key, kept``.

    ``component_id`` is the smallest id reachable by links, the document's own
    included. A null or empty text has no shingles and is linked with nothing.
    Rows that repeat a text are in one component whatever their ids; null ids
    keep their rows and are never the smallest unless all are null. ``kept``
    marks one text of each component, that of the smallest id (null last, then
    by ``text_key``, a hash of the text), and every row without shingles.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    cells = frequencies(rows.select("text"), width)
    signed = staged(_signatures(rows.withColumn("text_key", F.xxhash64("text")), cells, width, percent),
                    "jaccard_rows")
    tasks = max(1, -(-signed.count() // DOCS))
    first_row = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    classes = staged(signed.where("n > 0").groupBy("set_key").agg(
        F.min(first_row).alias("least"), F.first("n").alias("n"), F.first("group_key").alias("group_key")),
        "jaccard_classes", tasks)

    # Shingles in the prefixes of two groups or more.
    entries = signed.where("n > 0").select("group_key", "n", F.posexplode("prefix").alias("pos", "shingle"))
    shared = staged(entries.groupBy("shingle").agg(F.min("group_key").alias("lo"), F.max("group_key").alias("hi"))
                    .where("lo < hi").select("shingle"), "jaccard_shared", tasks)
    postings = staged(entries.join(shared, "shingle").select("shingle", "group_key", "n", "pos").distinct(),
                      "jaccard_postings", tasks)

    # Round 1: every group meets the hub of each of its shingles, every class the hub of its group. The draw does not
    # depend on the shingle, so a family of near copies has few hubs.
    draw = F.struct(F.xxhash64("group_key").alias("draw"), F.col("group_key").alias("hub"),
                    F.col("n").alias("hub_n"), F.col("pos").alias("hub_pos"))
    hubs = staged(postings.groupBy("shingle").agg(F.min(draw).alias("h"), (F.count(F.lit(1)) > HOT).alias("hot"))
                  .select("shingle", "h.*", "hot"), "jaccard_hubs", tasks)
    met = _group_pairs(postings.join(hubs, "shingle").where("group_key <> hub").select(
        F.col("group_key").alias("g1"), F.col("hub").alias("g2"), F.col("n").alias("n1"), F.col("hub_n").alias("n2"),
        F.col("pos").alias("p1"), F.col("hub_pos").alias("p2")), percent)
    members = classes.select("group_key", "set_key", "least")
    heads = classes.groupBy("group_key").agg(F.min("set_key").alias("head"))
    across = (met.join(heads.withColumnsRenamed({"group_key": "g1", "head": "a"}), "g1")
              .join(heads.withColumnsRenamed({"group_key": "g2", "head": "b"}), "g2").select("a", "b"))
    within = (classes.join(heads, "group_key").where("set_key <> head")
              .select(F.col("head").alias("a"), F.col("set_key").alias("b")))
    pairs = staged(across.unionByName(within), "jaccard_pairs", tasks)
    sets = _sets(pairs.select(F.col("a").alias("key")).union(pairs.select("b")), rows, width, tasks)
    first = _linked(pairs, sets, percent, tasks)
    roots = staged(components(first), "jaccard_roots", tasks)

    # Round 2: all pairs of groups that pass the filters and are not in one component, expanded to their classes.
    rooted = staged(members.join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
                    .withColumn("root", F.coalesce("root", "set_key")), "jaccard_rooted", tasks)
    spread = rooted.groupBy("group_key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    calm = postings.join(hubs.where("not hot").select("shingle"), "shingle")
    open_groups = staged(calm.join(spread, "group_key"), "jaccard_open", tasks)
    left = open_groups.withColumnsRenamed({"group_key": "g1", "n": "n1", "pos": "p1", "lo": "lo1", "hi": "hi1"})
    right = open_groups.withColumnsRenamed({"group_key": "g2", "n": "n2", "pos": "p2", "lo": "lo2", "hi": "hi2"})
    settled = ((F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo1") == F.col("lo2")))
    sized = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent
    meet = _group_pairs(left.join(right, "shingle").where((F.col("g1") < F.col("g2")) & ~settled & sized), percent)
    side = rooted.select("group_key", "set_key", "root")
    one = side.withColumnsRenamed({"group_key": "g1", "set_key": "a", "root": "r1"})
    two = side.withColumnsRenamed({"group_key": "g2", "set_key": "b", "root": "r2"})
    held = classes.groupBy("group_key").agg(F.count(F.lit(1)).alias("k"))
    meet = staged(meet.join(held.withColumnsRenamed({"group_key": "g1", "k": "k1"}), "g1")
                  .join(held.withColumnsRenamed({"group_key": "g2", "k": "k2"}), "g2")
                  .select("g1", "g2", (F.col("k1") * F.col("k2") > BLOCK).alias("many")), "jaccard_meet", tasks)
    across = meet.where("not many").join(one, "g1").join(two, "g2").where("r1 <> r2").select("a", "b")
    pairs = staged(across.join(first, ["a", "b"], "left_anti"), "jaccard_pairs", tasks)

    # Hot shingles, groups of several classes, and pairs of groups of many: families, a group's own key standing for
    # its common prefix.
    hot = (postings.join(hubs.where("hot").select("shingle", "hub"), "shingle").select("hub", "group_key").distinct()
           .join(rooted, "group_key").select("hub", "set_key", "root"))
    several = spread.where("lo <> hi").select("group_key")
    both = meet.where("many").select(F.xxhash64("g1", "g2").alias("hub"), F.explode(F.array("g1", "g2"))
                                     .alias("group_key"))
    families = staged(hot.unionByName(rooted.join(several, "group_key").select(
        F.col("group_key").alias("hub"), "set_key", "root"))
        .unionByName(both.join(rooted, "group_key").select("hub", "set_key", "root")).distinct(), "jaccard_families", tasks)
    rests = _with_rest(families, tasks)
    wanted = (pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(rests.select("set_key")))
    sets = _sets(wanted, rows, width, tasks)
    joins = _between(_linked(pairs, sets, percent, tasks), rooted, tasks)
    for turn in range(HUB_ROUNDS):
        if rests.where(F.col("n_rest") > BLOCK).isEmpty():
            break
        found = _between(_linked(_next_hubs(rests, turn, tasks), sets, percent, tasks), rooted, tasks)
        if found.isEmpty():
            break
        joins = joins.unionByName(found)
        rests = _with_rest(_joined(rests.select("hub", "set_key", "root"),
                                   staged(components(joins), "jaccard_roots", tasks)), tasks)
    joins = _family_joins(rests, joins, sets, percent, rooted, tasks)

    whole = _joined(rooted.select("set_key", "least", "root"), staged(components(joins), "jaccard_roots", tasks))
    least = staged(whole.groupBy("root").agg(F.min("least").alias("first")), "jaccard_least", tasks)
    named = staged(whole.join(least, "root").select("set_key", "first"), "jaccard_named", tasks)
    plain = signed.select("id", F.col("n").alias("n_shingles"), "set_key", "text_key")
    linked = plain.where("n_shingles > 0").join(named, "set_key").select(
        "id", "n_shingles", F.col("first.id").alias("component_id"), "text_key",
        (F.col("first") == first_row).alias("kept"))
    return linked.unionByName(plain.where("n_shingles = 0").select(
        "id", "n_shingles", F.col("id").alias("component_id"), "text_key", F.lit(True).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
             percent: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (same columns) that :func:`link_classes` keeps.

    Rows that agree in id and text stay or go together. Only rows whose key may
    be among those to drop are shuffled; the others pass through the scan.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    classes = link_classes(docs, id_col, text_col, width, percent)
    dropped = staged(classes.where("not kept").select(F.col("id").alias("__id"), F.col("text_key").alias("__text"))
                     .distinct(), "jaccard_dropped")
    key = F.xxhash64(F.col(f"`{id_col}`"), F.xxhash64(text_of(text_col)))
    bitmap = bitmap_of(dropped.select(F.xxhash64("__id", "__text").alias("key")), FILTER_BITS)
    flagged = flag_members(docs, key, bitmap, FILTER_BITS, "__drop")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(text_of(text_col)) == F.col("__text"))
    doubtful = flagged.where("__drop").join(dropped, same, "left_anti")
    return flagged.where("not __drop").select(*columns).unionByName(doubtful.select(*columns))
