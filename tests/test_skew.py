"""A key holding a third of all rows must not land in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dimflow.operators import lookup_join, positions_distributed
from dimflow.operators.joins import BUCKETS, SALT, salted_join, salted_rows
from dimflow.params import RunParams


def _share_of_largest_partition(df) -> float:
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture()
def shuffle_joins(spark):
    """Keep shuffle joins as planned (lookups this small would otherwise be broadcast at run time) and leave AQE's own
    skew handling out, to observe the salting itself."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("share", [1 / 3, 0.6, 0.9])
@pytest.mark.parametrize("equal_rows", [False, True])
def test_salted_join_spreads_a_hot_key(spark, shuffle_joins, share, equal_rows):
    """However large its share, and with all of its rows equal, a hot key gives no task twice the mean."""
    n = 40_000
    hot = F.col("id") < int(share * n)
    big = spark.range(n).select(
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.when(hot & F.lit(equal_rows), F.lit(0)).otherwise(F.col("id")).alias("v"))
    small = spark.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
                                    F.col("id").alias("w")).union(spark.createDataFrame([("HOT", -1)], "k string, w long"))
    params = RunParams(broadcast_max_rows=0, hot_key_share=0.01, skew_sample_fraction=0.05)
    joined = lookup_join(big, small, "k", "inner", params)
    assert joined.count() == n
    assert joined.filter("k = 'HOT'").count() == int(share * n)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _share_of_largest_partition(big.join(small, "k", "inner")) > share  # the hot key sits in one task
    assert _share_of_largest_partition(joined) < 2 / partitions


def test_salted_join_spreads_null_keys(spark, shuffle_joins):
    big = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), "id")
    small = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("w"))
    joined = lookup_join(big, small, "k", "left", RunParams(broadcast_max_rows=0, skew_sample_fraction=0.1))
    assert joined.count() == 20_000 and joined.filter("w is not null").count() == 50
    assert _share_of_largest_partition(joined) < 2 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_distributed_keys_split_a_run_of_identical_rows(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.lit("SAME")).otherwise(
        F.col("id").cast("string")).alias("CUST_ID"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pos = positions_distributed(df, ["CUST_ID"], num_partitions=8).cache()
        assert sorted(r[0] for r in pos.select("_dimflow_pos").collect()) == list(range(1, 9_001))
        ranged = df.repartitionByRange(8, "CUST_ID")
        assert _share_of_largest_partition(ranged) > 0.3         # range on the key alone: one partition
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _sales_after_a_shuffle(spark, *order):
    """Sales that come out of a shuffle, many equal in every column; a repeated task may read its rows in any ``order``."""
    sales = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 7 == 0, None).otherwise(
            F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), (F.col("id") % 11).alias("v"),
        F.when(F.col("id") % 5 == 0, F.lit(1.5)).alias("w"))
    return sales.repartition(6, "v").sortWithinPartitions(*order)


def _orders():
    return [("k", "v", "w"), (F.desc("w"), F.desc("v"), F.desc("k")), (F.xxhash64("k", "w"), F.asc_nulls_last("k"))]


def test_salts_do_not_depend_on_the_order_a_task_reads(spark):
    """Task by task, the same rows get the same salts: what another attempt writes can take the place of the first's."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.createDataFrame([("HOT", 16)], f"k string, {BUCKETS} int")
        seen = []
        for order in _orders():
            salted = salted_rows(_sales_after_a_shuffle(spark, *order), ["k"], hot, 8)
            seen.append(sorted(map(str, salted.withColumn("task", F.spark_partition_id()).collect())))
            salts = {r[0]: r[1] for r in salted.groupBy("k").agg(F.countDistinct(SALT)).collect()}
            assert salts.pop("HOT") == 16 and salts.pop(None) == 8 and set(salts.values()) == {1}
        assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 6_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_a_join_of_mixed_attempts_keeps_every_row(spark, shuffle_joins, how):
    """Half of the join's tasks read the first attempt's output, half that of an attempt with another row order."""
    hot = spark.createDataFrame([("HOT", 16)], f"k string, {BUCKETS} int")
    lookup = spark.createDataFrame([("HOT", 1), ("HOT", 2), ("k3", 3), ("k9", 4)], "k string, x int")
    attempts = [salted_join(_sales_after_a_shuffle(spark, *order), lookup, ["k"], how, hot, 8)
                .withColumn("task", F.spark_partition_id()) for order in _orders()[:2]]
    mixed = attempts[0].where("task % 2 = 0").union(attempts[1].where("task % 2 = 1")).drop("task")
    plain = _sales_after_a_shuffle(spark, "k").join(lookup, "k", how)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, plain.collect()))
