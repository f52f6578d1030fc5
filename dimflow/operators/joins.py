"""Joins that stay safe at scale: proven-size broadcasts and salted shuffles.

A lookup join is *planned* once (:func:`plan_lookup`) and the plan is shared by
every join of the same big frame against the same lookup frame, so size checks
and skew sampling run once per lookup, not once per output:

1. ``broadcast`` — a measured size (rows and UnsafeRow bytes, one aggregate
   pass, one partial row per task) proves the lookup side is within
   ``broadcast_max_rows`` and ``broadcast_max_bytes``: the big side is never
   shuffled.
2. ``reduced`` — the big side has few distinct keys (a HyperLogLog sketch
   first, then an exact distinct count), e.g. a daily change feed against a
   large dimension: the lookup side is cut to those keys by a broadcast
   semi-join, checkpointed, and broadcast once its measured size is within
   bounds. The large side is scanned once and never shuffled.
3. ``salted`` — a shuffle join on the key, salted against skew: keys holding at
   least ``hot_key_share`` of a seeded sample of the big side (at most
   ``1 / hot_key_share`` keys by construction) are spread over as many tasks as
   their share of the shuffle partitions, NULL keys over all of them; the lookup
   rows of a hot key are replicated once per bucket of that key. Every row still
   meets exactly the lookup rows it would meet unsalted.

The sketch and the skew sample come from one scan of the big side's key column.

Sizes are never proven with ``limit(n).count()``: that plan funnels up to ``n``
rows of every partition through one task. An exact count aggregates partially
and moves one row per task.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions import any_of
from dimflow.params import RunParams
from dimflow.session import materialize

SALT = "_dimflow_salt"
BUCKETS = "_dimflow_buckets"
BUCKETS_PER_TASK = 8  # buckets fall on tasks by hash; several for each even out
HITS = "_hits"
SAMPLE_SEED = 20260728
# HyperLogLog relative error used to skip the exact distinct count when it cannot pass.
KEY_ESTIMATE_RSD = 0.05
STRATEGIES = ("broadcast", "reduced", "salted")


@dataclass(frozen=True)
class Size:
    """Measured rows and bytes (UnsafeRow footprint) of a frame."""

    rows: int
    bytes: int

    def __add__(self, other: Size) -> Size:
        return Size(self.rows + other.rows, self.bytes + other.bytes)


UNBOUNDED = Size(sys.maxsize, sys.maxsize)


def row_bytes(df: DataFrame) -> Column:
    """Bytes one row takes as an UnsafeRow: null bits, one 8-byte slot per field,
    plus the 8-byte-aligned payload of variable-length fields.

    Built as one SQL expression (one call into the JVM, not one per field).
    """
    fields = df.schema.fields
    terms = [f"CAST({8 * ((len(fields) + 63) // 64) + 8 * len(fields)} AS BIGINT)"]
    for f in fields:
        c, t = "`" + f.name.replace("`", "``") + "`", f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            terms.append(f"coalesce(((CAST(octet_length({c}) AS BIGINT) + 7) >> 3) << 3, 0)")
        elif isinstance(t, T.DecimalType) and t.precision > 18:
            terms.append(f"if({c} IS NULL, 0, 16)")
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            terms.append(f"coalesce(((CAST(octet_length(to_json({c})) AS BIGINT) + 7) >> 3) << 3, 0)")
    return F.expr(f"CAST({' + '.join(terms)} AS BIGINT)")


def measure(df: DataFrame) -> Size:
    """Exact rows and bytes of ``df`` in one aggregate pass (partial per task)."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return Size(int(row["rows"]), int(row["bytes"] or 0))


def materialize_measured(df: DataFrame, **counts: Column) -> tuple[DataFrame, Size, dict]:
    """Reliable checkpoint of ``df``, its exact size and further ``counts``, observed by the checkpoint job itself."""
    obs = Observation(f"size_{uuid.uuid4().hex}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.coalesce(F.sum(row_bytes(df)), F.lit(0).cast("long")).alias("bytes"),
                          *[c.alias(name) for name, c in counts.items()])
    ckpt = materialize(observed)
    got = obs.get
    return ckpt, Size(int(got["rows"]), int(got["bytes"])), got


def fits_broadcast(size: Size, params: RunParams) -> bool:
    """Whether a side of ``size`` is within both broadcast bounds."""
    return size.rows <= params.broadcast_max_rows and size.bytes <= params.broadcast_max_bytes


@dataclass(frozen=True)
class KeyProfile:
    """What one scan of a big side's key column tells the join planner."""

    distinct_estimate: int   # HyperLogLog estimate of the distinct non-NULL keys
    sampled: DataFrame       # checkpointed ``(key..., _hits)`` of the keys with enough hits in a seeded sample
    sampled_rows: int


def profile_keys(df: DataFrame, on: list[str], params: RunParams) -> KeyProfile:
    """One scan of ``df``'s keys: a distinct-count sketch over all of them and a seeded sample's key counts.

    The sketch is observed in the same job that checkpoints the sampled counts
    (merging a sketch twice changes nothing, so a retried task cannot skew it).
    Only keys with ``hot_key_hits`` hits or more are written. An empty sample lets
    adaptive execution drop the whole plan, sketch included; that only happens to
    tiny inputs, and then the sketch is a separate (tiny) pass.
    """
    keys = df.select(*on).dropna()
    key = F.col(on[0]) if len(on) == 1 else F.struct(*[F.col(c) for c in on])
    estimate = F.approx_count_distinct(key, rsd=KEY_ESTIMATE_RSD).alias("n")
    sketch, total = Observation(f"keys_{uuid.uuid4().hex}"), Observation(f"sample_{uuid.uuid4().hex}")
    sampled = (keys.observe(sketch, estimate)
               .sample(fraction=params.skew_sample_fraction, seed=SAMPLE_SEED)
               .groupBy(*on).agg(F.count(F.lit(1)).alias(HITS))
               .observe(total, F.coalesce(F.sum(HITS), F.lit(0).cast("long")).alias("n")))
    pinned = materialize(sampled.filter(F.col(HITS) >= F.lit(params.hot_key_hits)))
    sampled_rows = int(total.get["n"])
    distinct = int(sketch.get["n"]) if sampled_rows else int(keys.agg(estimate).first()["n"])
    return KeyProfile(distinct, pinned, sampled_rows)


def hot_keys(profile: KeyProfile, on: list[str], params: RunParams, partitions: int) -> DataFrame:
    """Keys with at least ``hot_key_share`` of the sample and their buckets: ``BUCKETS_PER_TASK`` for each partition
    that their share of the rows would fill, rounded up to a power of two.

    At most ``1 / hot_key_share`` rows come back (each hot key holds at least that
    share of the sample), so the list is safe to pass through the driver and to
    broadcast. Detection only routes rows; results never depend on it.
    """
    threshold = max(params.hot_key_share * profile.sampled_rows, params.hot_key_hits)
    share = F.col(HITS) / F.lit(float(max(1, profile.sampled_rows)))
    wanted = share * F.lit(float(BUCKETS_PER_TASK * partitions))
    buckets = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(wanted, F.lit(1.0))))).cast("int")
    hot = profile.sampled.filter(F.col(HITS) >= F.lit(threshold)).select(*on, buckets.alias(BUCKETS))
    # Pin the (bounded) key list so both join sides see the very same hot set,
    # even if the sample were recomputed on another partitioning.
    return profile.sampled.sparkSession.createDataFrame(hot.collect(), hot.schema)


def _any_null(on: list[str]) -> Column:
    return any_of(*[F.col(c).isNull() for c in on])


def salted_rows(big: DataFrame, on: list[str], hot: DataFrame, null_buckets: int) -> DataFrame:
    """``big`` with its salt: rows of hot keys are spread over their buckets, NULL keys over ``null_buckets``.

    The salt must not depend on the order in which a task sees its rows, since a
    task that reads a shuffle may see another order when it is repeated, and a row
    whose salt changed would be lost or doubled. The rows to spread are therefore
    sorted by all of their values inside their partition first and salted by their
    place in that order: only rows equal in every column can change places. Other
    rows take no part in that order; theirs is salt 0.
    """
    columns = big.columns
    buckets = F.coalesce(F.col(BUCKETS), F.when(_any_null(on), F.lit(null_buckets)))
    spread = big.join(F.broadcast(hot), on, "left").select(*columns, buckets.alias(BUCKETS))
    is_spread = F.col(BUCKETS).isNotNull()
    first = F.when(is_spread, F.xxhash64(*columns)).asc_nulls_last()  # mostly decides alone
    place = F.xxhash64(F.monotonically_increasing_id())
    return (spread.sortWithinPartitions(first, *[F.when(is_spread, F.col(c)) for c in columns])
            .withColumn(SALT, F.when(is_spread, F.pmod(place, F.col(BUCKETS)).cast("int")).otherwise(F.lit(0)))
            .drop(BUCKETS))


def salted_join(big: DataFrame, lookup: DataFrame, on: list[str], how: str, hot: DataFrame,
                null_buckets: int) -> DataFrame:
    """Shuffle join on ``on`` + salt (:func:`salted_rows`); the lookup rows of a hot key go to each of its buckets."""
    lookup_salted = (
        lookup.join(F.broadcast(hot), on, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(BUCKETS), F.lit(1)) - 1)))
        .drop(BUCKETS)
    )
    return salted_rows(big, on, hot, null_buckets).join(lookup_salted, [*on, SALT], how).drop(SALT)


@dataclass(frozen=True)
class LookupPlan:
    """How a big frame is joined with a lookup frame; shared by all joins of the pair.

    A ``reduced`` plan holds the lookup rows of the big frame's keys only, so it
    serves joins of that big frame (or of any frame whose keys are a subset).
    """

    lookup: DataFrame
    on: tuple[str, ...]
    strategy: str
    hot: DataFrame | None = None
    buckets: int = 1

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}, got {self.strategy!r}")
        if self.strategy == "salted" and self.hot is None:
            raise ValueError("a salted plan needs its hot-key list")

    def side(self, columns: list[str] | None = None) -> DataFrame:
        if columns is None:
            return self.lookup
        return self.lookup.select(*self.on, *[c for c in columns if c not in self.on])

    def join(self, big: DataFrame, how: str, columns: list[str] | None = None) -> DataFrame:
        """``big JOIN lookup USING (on)``; ``columns`` — lookup columns to bring (default all)."""
        side = self.side(columns)
        if self.strategy == "salted":
            return salted_join(big, side, list(self.on), how, self.hot, self.buckets)
        return big.join(F.broadcast(side), list(self.on), how)


def _reduce_to_keys(big: DataFrame, lookup: DataFrame, on: list[str], params: RunParams) -> DataFrame | None:
    """Lookup rows of ``big``'s keys, checkpointed, if they provably fit a broadcast; else ``None``."""
    distinct, distinct_size, _ = materialize_measured(big.select(*on).dropna().distinct())
    if not fits_broadcast(distinct_size, params):
        return None
    reduced, reduced_size, _ = materialize_measured(lookup.join(F.broadcast(distinct), on, "left_semi"))
    return reduced if fits_broadcast(reduced_size, params) else None


def plan_lookup(big: DataFrame, lookup: DataFrame, on: str | list[str], params: RunParams,
                lookup_size: Size | None = None) -> LookupPlan:
    """Decide once how ``big`` is joined with ``lookup`` (see the module notes).

    ``lookup_size`` — what the caller already proved: an upper bound on the
    lookup side (e.g. a measured table plus a checkpointed delta), or
    :data:`UNBOUNDED` when it is known to be large. Without it, one pass measures.
    """
    on = [on] if isinstance(on, str) else list(on)
    size = lookup_size if lookup_size is not None else measure(lookup)
    if fits_broadcast(size, params):
        return LookupPlan(lookup, tuple(on), "broadcast")
    profile = profile_keys(big, on, params)  # one scan of the big side's keys serves both checks below
    # Far above the cap, an exact distinct count would shuffle every key for nothing.
    if profile.distinct_estimate <= params.broadcast_max_rows * (1 + 3 * KEY_ESTIMATE_RSD):
        reduced = _reduce_to_keys(big, lookup, on, params)
        if reduced is not None:
            return LookupPlan(reduced, tuple(on), "reduced")
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return LookupPlan(lookup, tuple(on), "salted", hot_keys(profile, on, params, partitions),
                      BUCKETS_PER_TASK * partitions)


def lookup_join(big: DataFrame, lookup: DataFrame, on: str | list[str], how: str,
                params: RunParams, lookup_size: Size | None = None) -> DataFrame:
    """``big JOIN lookup USING (on)`` for ``how`` in inner / left / left_anti / left_semi."""
    return plan_lookup(big, lookup, on, params, lookup_size).join(big, how)
