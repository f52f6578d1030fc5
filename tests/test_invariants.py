"""Invariants of a daily run on the sf0.001 test tables, and the oracle check."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.operators import latest_per_key, scd2
from dimflow.plans import Inputs, plan
from dimflow.plans.queries import PARAMS, REGISTRY, fixture_inputs


@pytest.fixture(scope="module")
def run(spark):
    inputs = fixture_inputs(spark, SF_SMALL)
    return inputs, plan(inputs, PARAMS)


@pytest.fixture(scope="module")
def single(spark):
    """The same day with one current row and one feed row for each customer."""
    inputs = fixture_inputs(spark, SF_SMALL)
    inputs = replace(inputs, dimension=inputs.dimension.filter(~F.col("CUST_NAME").endswith("(2)")))
    return inputs, plan(inputs, PARAMS.with_(dedupe_feed=True))


def test_partitions_of_the_sales(spark, run):
    inputs, out = run
    matched = inputs.sales_txn.join(out.current_after.select("CUST_ID"), "CUST_ID", "left_semi")
    assert out.lookup_rejects.count() + matched.count() == inputs.sales_txn.count()
    assert out.enriched.count() > matched.count()  # customers with two current rows fan out
    assert out.dq_pass.count() + out.dq_rejects.count() + out.dq_unclassified.count() == out.enriched.count()
    assert out.errors.count() == out.lookup_rejects.count() + out.dq_rejects.count()


def test_dimension_after_keys(spark, run):
    _, out = run
    dim = out.dimension_after
    assert dim.count() == dim.select("CUST_KEY").distinct().count()          # keys unique
    new_keys = [r.CUST_KEY for r in out.new_versions.select("CUST_KEY").collect()]
    assert sorted(new_keys) == list(range(out.key_base, out.key_base + len(new_keys)))  # dense keys


def test_dimension_after_invariants(spark, single):
    _, out = single
    dim = out.dimension_after
    per_customer = dim.filter(F.col("CURR_FLAG") == "Y").groupBy("CUST_ID").count()
    assert per_customer.filter("count > 1").count() == 0                      # one current row each
    w = Window.partitionBy("CUST_ID").orderBy("EFF_DATE")
    overlaps = (dim.withColumn("next_eff", F.lead("EFF_DATE").over(w))
                .filter(F.col("next_eff").isNotNull() & (F.col("EXP_DATE") >= F.col("next_eff"))))
    assert overlaps.count() == 0                                             # history intervals disjoint


def test_second_run_with_same_feed_has_no_changes(spark, single):
    inputs, out = single
    again = plan(Inputs(customer_delta=inputs.customer_delta, sales_txn=inputs.sales_txn,
                        dimension=out.dimension_after), PARAMS.with_(run_date="2026-07-29", dedupe_feed=True))
    assert again.change_rows == 0


def test_the_feed_exercises_the_rules(spark, run):
    inputs, out = run
    feed = inputs.customer_delta
    assert feed.filter("CUST_ID IS NULL").count() > 0 and out.changes.filter("CUST_ID IS NULL").count() == 0
    assert latest_per_key(feed, "CUST_ID", "EFF_DATE").count() < feed.count()
    assert inputs.dimension.filter("CURR_FLAG = 'N'").count() > 0
    assert out.expired_rows > 0 and out.new_rows > out.expired_rows


def test_sales_sorted_order(spark):
    """Rows in the order of the three keys, nulls first."""
    got = [(r.CUST_KEY, r.PRODUCT_ID, r.STORE_ID) for r in REGISTRY["sales_sorted"](spark, SF_SMALL).collect()]
    assert got == sorted(got, key=lambda t: tuple((v is not None, v) for v in t))
    assert any(t[2] is None for t in got) and any(t[2] is not None for t in got)


def test_surrogate_keys_use_no_single_partition(spark):
    plan_text = REGISTRY["surrogate_keys"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    single_steps = plan_text.count("SinglePartition")
    assert single_steps <= 1 and "row_number" not in plan_text  # the one is over one row per partition


def test_fact_totals_match_passed_rows(spark, run):
    _, out = run
    fact = out.fact.agg(F.sum("TOTAL_QTY").alias("q"), F.sum("TXN_COUNT").alias("n")).first()
    rows = out.dq_pass.agg(F.sum("QTY").alias("q"), F.count("TXN_ID").alias("n")).first()
    assert (fact.q, fact.n) == (rows.q, rows.n)
    assert out.fact.columns == S.names(S.SALES_FACT)


def test_registered_queries_match_oracle(spark):
    from oracle_compare import compare

    report = compare(spark, SF_SMALL, list(REGISTRY))
    bad = {k: v for k, v in report.items() if v.get("hash_ok") is not True}
    assert not bad, bad


def test_audit_counts_equal_each_output(spark, run):
    from dimflow.plans.daily_run import AUDITED, audit

    inputs, out = run
    got = {r.OUTPUT: r.ROW_COUNT for r in audit(inputs, out).collect()}
    frames = {"customer_delta": inputs.customer_delta, "sales_txn": inputs.sales_txn,
              "dimension_current": inputs.dimension.filter("CURR_FLAG = 'Y'")}
    want = {name: (frames[name] if name in frames else getattr(out, name)).count() for name in AUDITED}
    assert got == want


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_join_strategy_gives_the_same_run(spark, run):
    """Broadcast, reduce-to-keys and salted shuffle agree on every output of the day."""
    inputs, out = run
    assert out.lookup_plan.strategy == "broadcast"
    forced = {
        # the post-load bound (current + new rows) is over the cap; the sales'
        # distinct customers and their current rows are not
        "reduced": PARAMS.with_(broadcast_max_rows=out.current_after.count()),
        "salted": PARAMS.with_(broadcast_max_rows=0, skew_sample_fraction=0.5, hot_key_share=0.01),
    }
    for strategy, params in forced.items():
        other = plan(inputs, params)
        assert other.lookup_plan.strategy == strategy
        for name in ("fact", "errors", "dimension_after", "current_after", "dimension_closed", "dq_unclassified"):
            assert _bag(getattr(other, name)) == _bag(getattr(out, name)), (strategy, name)


def test_distributed_keys_over_the_checkpointed_change_set(spark, run):
    inputs, out = run
    order = Window.orderBy(*[F.col(c).asc_nulls_first() for c in scd2.key_order()])
    needs_key = out.changes.filter(F.col("CHANGE_CODE").isin(S.INSERT, S.EDIT))
    want = needs_key.select((F.row_number().over(order) + out.key_base - 1).alias("CUST_KEY"), "CUST_ID")
    assert _bag(out.new_versions.select("CUST_KEY", "CUST_ID")) == _bag(want)
    assert out.next_key == out.key_base + want.count()
