"""Dense surrogate keys: ``base + position - 1`` over a total order.

Rows are range-partitioned on the order and sorted inside partitions; the rows
per partition are counted (one small row per partition), and a prefix sum of
those counts plus a row's index inside its partition is its position. The
numbers are those of a global ``row_number``, without its single partition. The
input is checkpointed first so a recomputed partition cannot get different
boundaries or positions.

The order must be total for results not to depend on partitioning: callers pass
the business key followed by tie-breaker columns. Rows identical in all order
columns are interchangeable, so a stable sequence column is appended as the
last range key only to let such a run spread over several partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import materialize

POS = "_dimflow_pos"
SEQ = "_dimflow_seq"
PID = "_dimflow_pid"
IDX = "_dimflow_idx"
# monotonically_increasing_id() keeps the record number inside a partition in its low 33 bits.
LOCAL_INDEX_MASK = (1 << 33) - 1


def _ordered(cols: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def key_base(dim: DataFrame, key: str) -> int:
    """Next free key: ``max(key) + 1`` over the whole dimension (1 when it is empty)."""
    top = dim.agg(F.max(key).alias("m")).first()["m"]
    return 1 if top is None else int(top) + 1


def positions_distributed(df: DataFrame, order_by: list[str], num_partitions: int | None = None,
                          stable_input: bool = False) -> DataFrame:
    """1-based dense position without a single-partition step (same numbers as the window).

    ``stable_input`` — ``df`` already reads a checkpoint (or another fixed table),
    so recomputing it yields the same partitions in the same order and it need
    not be checkpointed again.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stable = (df if stable_input else materialize(df)).withColumn(SEQ, F.monotonically_increasing_id())
    local = (
        stable.repartitionByRange(n, *_ordered(order_by), F.col(SEQ))
        .sortWithinPartitions(*_ordered(order_by), F.col(SEQ))
        .withColumn(PID, F.spark_partition_id())
        .withColumn(IDX, F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL_INDEX_MASK)))
    )
    local = materialize(local)
    sizes = local.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        local.join(F.broadcast(offsets), PID)
        .withColumn(POS, F.col("_off") + F.col(IDX) + F.lit(1))
        .drop(PID, IDX, SEQ, "_off")
    )


def assign_keys(df: DataFrame, order_by: list[str], base: int, key: str, stable_input: bool = False) -> DataFrame:
    """Add ``key = base + position - 1`` (int; ANSI mode raises on overflow).

    ``stable_input`` — ``df`` reads a checkpoint; see :func:`positions_distributed`.
    """
    numbered = positions_distributed(df, order_by, stable_input=stable_input)
    return numbered.withColumn(key, (F.lit(base) + F.col(POS) - F.lit(1)).cast("int")).drop(POS)
