"""Lloyd's clustering of integer vectors, exact, with Ns-bounds (norms of total displacement) to skip distances.

Every vector keeps, for each centroid, the exact squared distance of its last
evaluation and the round of it. The centroids of all rounds are retained (rounds
x k vectors, a fixed size), so a stored distance is loosened by how far the
centroid is *now* from where it was *then*: the norm of the total displacement,
which is never more than the sum of the single rounds' drifts. As long as the
upper bound of the own centroid stays below the lower bounds of all others, the
vector keeps its centroid unseen. Where a bound fails, first the own distance is
evaluated anew, then those of the centroids that still may be as near; integers
decide, so ties go to the smaller number exactly. Bounds are compared with a
margin far above what rounding may do to them.

A round is one pass over the vectors without any shuffle of them: a task adds up
the vectors of each cluster and sends k sums a batch. Vectors and bounds are
written to the shared folder after each round, and the table of the round before
is removed, so two of them exist at a time and a lost executor repeats tasks of
one round only. Copies of a vector, however many, are single rows of that pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import ship_package
from dimflow.session import drop_scratch, scratch_path

CLUSTERS, ROUNDS, DIMS, SCALE = 8, 10, 64, 1024
START_SALT = "3:"
MOST = 1 << 27  # components beyond are cut to it: squared distances of 64 of them fit a long
MARGIN = 1e-9

STATE = "vector binary, near binary, seen binary, cluster int, distance long, sums array<bigint>"


def quantise(vectors: pa.Array, dims: int = DIMS, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of every component, one row a vector (lists of ``dims`` finite numbers)."""
    x = np.asarray(pc.list_flatten(vectors).to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -MOST, MOST).astype(np.int64)


def squared(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = vectors - centre
    return np.einsum("ij,ij->i", apart, apart)


def assign(vectors: np.ndarray, history: np.ndarray, near: np.ndarray, seen: np.ndarray, own: np.ndarray) -> int:
    """Bring ``near``, ``seen`` and ``own`` (changed in place) up to the last centroids of ``history``.

    ``near`` holds squared distances (rows x k), ``seen`` the rounds of their evaluation, ``own``
    the cluster of each row. Returns the number of distances evaluated.
    """
    now = len(history) - 1
    centres, k = history[now], history.shape[1]
    moved = np.sqrt((np.square((history - centres).astype(np.float64))).sum(2))  # round x centroid
    rows, which = np.arange(len(vectors)), np.arange(k)
    low = (np.sqrt(near.astype(np.float64)) - moved[seen, which]) * (1 - MARGIN) - MARGIN
    low[rows, own] = np.inf
    high = (np.sqrt(near[rows, own].astype(np.float64)) + moved[seen[rows, own], own]) * (1 + MARGIN)
    open_rows = np.flatnonzero(low.min(1) <= high) if k > 1 else rows[:0]
    evaluated = 0
    if len(open_rows):
        stale = open_rows[seen[open_rows, own[open_rows]] != now]
        near[stale, own[stale]] = squared(vectors[stale], centres[own[stale]])
        seen[stale, own[stale]] = now
        evaluated += len(stale)
        high = np.sqrt(near[open_rows, own[open_rows]].astype(np.float64)) * (1 + MARGIN)
        fails = low[open_rows] <= high[:, None]
        for j in which:
            again = open_rows[fails[:, j]]
            near[again, j] = squared(vectors[again], centres[j])
            seen[again, j] = now
            evaluated += len(again)
        exact = np.where(fails, near[open_rows], np.iinfo(np.int64).max)
        mine = own[open_rows]
        exact[np.arange(len(open_rows)), mine] = near[open_rows, mine]
        own[open_rows] = exact.argmin(1)  # the first of equal ones
    return evaluated


def first_assign(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    near = np.stack([squared(vectors, c) for c in centres], 1) if len(vectors) else np.zeros((0, len(centres)), np.int64)
    return near, np.zeros(near.shape, np.uint8), near.argmin(1).astype(np.int64)


def _packed(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(values)
    width = data.strides[0] if len(data) else 1
    ends = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _unpacked(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).copy()


def _round(rows: DataFrame, history: np.ndarray, first: bool, last: bool, id_type: str) -> DataFrame:
    """One assignment pass; the ids and ``STATE`` of all vectors and, for each batch, a row with the clusters' sums."""
    _, k, dims = history.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            if not len(ids):
                continue
            if first:
                vectors = quantise(batch.column(1), dims)
                near, seen, own = first_assign(vectors, history[0])
            else:
                vectors = _unpacked(batch.column(1), np.int32, dims).astype(np.int64)
                near, seen = _unpacked(batch.column(2), np.int64, k), _unpacked(batch.column(3), np.uint8, k)
                own = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
                assign(vectors, history, near, seen, own)
            distance, state = pa.nulls(len(ids), pa.int64()), [pa.nulls(len(ids), pa.binary())] * 3
            if last:
                distance = pa.array(squared(vectors, history[-1][own]))
            else:
                state = [_packed(vectors.astype(np.int32)), _packed(near), _packed(seen)]
            yield pa.RecordBatch.from_arrays([ids, *state, pa.array(own.astype(np.int32)), distance,
                                              pa.nulls(len(ids), pa.list_(pa.int64()))], names=names)
            if not last:
                total = np.zeros((k, dims + 1), np.int64)
                for j in range(k):
                    mine = own == j
                    total[j, :dims], total[j, dims] = vectors[mine].sum(0), mine.sum()
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, ids.type), *[pa.nulls(1, pa.binary())] * 3, pa.nulls(1, pa.int32()),
                     pa.nulls(1, pa.int64()), pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], names=names)

    names = ["id", "vector", "near", "seen", "cluster", "distance", "sums"]
    return rows.mapInArrow(run, f"id {id_type}, {STATE}")


def _moved_centres(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Componentwise ``floor(sum / count)`` of every cluster, exact; an empty cluster's centroid stays."""
    k, dims = centres.shape
    totals = (state.where("sums is not null").select(F.posexplode("sums").alias("at", "part"))
              .groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())  # k * (dims + 1) rows
    flat = [0] * (k * (dims + 1))
    for row in totals:
        flat[row["at"]] = int(row["total"])
    moved = centres.copy()
    for j in range(k):
        *sums, count = flat[j * (dims + 1):(j + 1) * (dims + 1)]
        if count:
            moved[j] = [s // count for s in sums]
    return moved


def starts(rows: DataFrame, clusters: int = CLUSTERS, dims: int = DIMS, scale: int = SCALE) -> np.ndarray:
    """The vectors of the rows (``id, embedding``) with the least hashes of their ids; null ids last, ties by vector."""
    chosen = (rows.withColumn("__hash", F.sha2(F.concat(F.lit(START_SALT), F.col("id").cast("string")), 256))
              .orderBy(F.asc_nulls_last("__hash"), "embedding").limit(clusters).select("embedding").collect())
    values = pa.array([list(r["embedding"]) for r in chosen], pa.list_(pa.float64()))
    return quantise(values, dims, scale)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, dims: int = DIMS) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` (squared, to the final centroid) of every kept vector, and the final centroids.

    Kept are vectors of exactly ``dims`` components, none null, NaN or infinite;
    others, null vectors too, have no row. Components are quantised to
    ``floor(1024 * x)`` and cut to 2^27 either way. Rows that repeat an id or a
    vector count each; with fewer kept vectors than ``clusters`` there are as
    many clusters as vectors, without any the result is empty. Further columns
    are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    x = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), x.alias("embedding")).where(
        F.coalesce(F.size("embedding") == dims, F.lit(False))
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    id_type = rows.schema["id"].dataType.simpleString()
    history = starts(rows, clusters, dims)[None]
    if not history.shape[1]:
        return spark.createDataFrame([], f"id {id_type}, cluster int, distance long"), history[0]
    state, path = rows, None
    for now in range(rounds + 1):
        last = now == rounds
        target = scratch_path(spark, "clustering")
        passed = _round(state, history, now == 0, last, id_type)
        passed.write.parquet(target)
        state = spark.read.schema(passed.schema).parquet(target)
        if path:
            drop_scratch(spark, path)
        path = target
        if not last:
            history = np.concatenate([history, _moved_centres(state, history[-1])[None]])
            state = state.where("sums is null").select("id", "vector", "near", "seen", "cluster")
    return state.select("id", "cluster", "distance"), history[-1]


def with_inertia(assigned: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia, inertia, centroid_sha256`` to every row of :func:`cluster`; joins k rows."""
    spark = assigned.sparkSession
    hashes = [(j, hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest()) for j, c in enumerate(centres)]
    named = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # k rows
    inertia = spark.createDataFrame([(j, n) for j, n in sums.items()], "cluster int, cluster_inertia long")
    info = named.join(F.broadcast(inertia), "cluster").withColumn("inertia", F.lit(sum(sums.values())).cast("long"))
    return assigned.join(F.broadcast(info), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia",
                                                              "centroid_sha256")
