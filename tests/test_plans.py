"""Physical-plan shape checks: broadcasts only under a bound, pushdown, pruning."""

from __future__ import annotations

import contextlib
import io

from conftest import SF_SMALL

from dimflow.operators import lookup_join, plan_lookup
from dimflow.plans import plan
from dimflow.plans.queries import PARAMS, fixture_inputs
from dimflow.session import scratch_path
from dimflow.sources.dimension import current_rows


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_broadcasts_bounded_dimension_and_shuffles_once(spark):
    text = physical(plan(fixture_inputs(spark, SF_SMALL), PARAMS).fact)
    assert "SortMergeJoin" not in text
    assert "BroadcastHashJoin Inner" in text
    assert "SinglePartition" not in text
    # DQ predicates reach the line-item filter below the joins.
    conditions = [line for line in text.splitlines() if line.startswith("Condition")]
    assert any("l_extendedprice" in c and "> 0.00" in c and "o_" not in c for c in conditions)


def test_unbounded_lookup_uses_salted_shuffle_join(spark):
    params = PARAMS.with_(broadcast_max_rows=0, skew_sample_fraction=0.5)
    text = physical(plan(fixture_inputs(spark, SF_SMALL), params).fact)
    assert "SortMergeJoin Inner" in text
    assert "_dimflow_salt" in text


def test_semi_join_reduction_when_big_side_keys_are_few(spark):
    big = spark.createDataFrame([("a", 1), ("b", 2), ("7", 3), (None, 4)], "k string, v int")
    lookup = spark.range(50).selectExpr("cast(id as string) as k", "id as w")
    params = PARAMS.with_(broadcast_max_rows=10)
    plan = plan_lookup(big, lookup, "k", params)
    assert plan.strategy == "reduced" and plan.lookup.count() == 1   # only key '7' survives
    joined = plan.join(big, "left")
    text = physical(joined)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted((r.k, r.w) for r in joined.collect() if r.k is not None) == [("7", 7), ("a", None), ("b", None)]
    assert joined.count() == 4


def test_byte_bound_blocks_a_wide_broadcast(spark):
    lookup = spark.range(20).selectExpr("cast(id as string) as k", "repeat('x', 1000) as wide")
    params = PARAMS.with_(broadcast_max_bytes=10_000)
    big = spark.range(100).selectExpr("cast(id % 40 as string) as k")
    assert plan_lookup(big, lookup, "k", params).strategy == "salted"   # 40 keys > 20k bytes of lookup
    assert plan_lookup(big, lookup, "k", PARAMS).strategy == "broadcast"
    assert lookup_join(big, lookup, "k", "inner", params).count() == 60   # keys 0-19, three ids each


def test_current_scan_prunes_flag_partition(spark):
    path = scratch_path(spark, "plan_dim")
    plan(fixture_inputs(spark, SF_SMALL), PARAMS).dimension_after.write.partitionBy("CURR_FLAG").parquet(path)
    text = physical(current_rows(spark.read.parquet(path)).select("CUST_ID", "CUST_KEY"))
    assert "PartitionFilters: [isnotnull(CURR_FLAG" in text and "(CURR_FLAG#" in text
    assert "ReadSchema: struct<CUST_KEY:int,CUST_ID:string>" in text


def test_load_audit_scans_the_sales_once(spark):
    from dimflow.plans.daily_run import audit

    inputs = fixture_inputs(spark, SF_SMALL)
    text = physical(audit(inputs, plan(inputs, PARAMS)))
    scans = [line for line in text.splitlines() if line.startswith("Location:") and "lineitem.parquet" in line]
    assert len(scans) == 1


def test_salted_fact_and_error_log_share_one_persisted_join(spark):
    from pyspark import StorageLevel

    out = plan(fixture_inputs(spark, SF_SMALL), PARAMS.with_(broadcast_max_rows=0, skew_sample_fraction=0.5))
    assert out.lookup_plan.strategy == "salted"
    out.tagged_sales.persist(StorageLevel.DISK_ONLY)
    try:
        for df in (out.fact, out.errors):
            text = physical(df)
            above_cache = text.split("InMemoryRelation")[0]      # below it: how the cache is built, once
            assert "InMemoryTableScan" in above_cache and "SortMergeJoin" not in above_cache
    finally:
        out.tagged_sales.unpersist()


def test_salted_publish_writes_the_same_outputs(spark):
    from dimflow.plans import Targets, publish
    from dimflow.sinks import read_error_log, read_fact

    inputs = fixture_inputs(spark, SF_SMALL)
    counts = {}
    for name, params in (("broadcast", PARAMS), ("salted", PARAMS.with_(broadcast_max_rows=0))):
        out = plan(inputs, params)
        assert out.lookup_plan.strategy == name
        t = Targets(scratch_path(spark, "dim"), scratch_path(spark, "fact"), scratch_path(spark, "err"))
        c = publish(out, t, params)
        fact = read_fact(spark, t.fact_path, params.run_date)
        errs = read_error_log(spark, t.error_dir, params.run_date).drop("ERROR_TIMESTAMP")
        counts[name] = (c, sorted(map(tuple, fact.collect()), key=str), sorted(map(tuple, errs.collect()), key=str))
    assert counts["broadcast"] == counts["salted"]


def test_salted_publish_releases_the_shared_join(spark):
    from dimflow.plans import Targets, publish

    params = PARAMS.with_(broadcast_max_rows=0)
    out = plan(fixture_inputs(spark, SF_SMALL), params)
    t = Targets(scratch_path(spark, "dim"), scratch_path(spark, "fact"), scratch_path(spark, "err"))
    counts = publish(out, t, params)
    assert counts["fact"] > 0 and counts["errors"] > 0
    assert not out.tagged_sales.is_cached
