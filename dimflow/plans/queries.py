"""Named queries over the test tables: one per operator / composite job.

Every query reads the whole given tables through the adapters in
:mod:`dimflow.sources.fixtures`, which keep or drop customers by the dates of
their orders only, and returns a DataFrame. Sink round-trips write
to a fresh folder under the session's shared checkpoint folder and read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimflow import schemas as S
from dimflow.operators import changes, facts, keys, lookup, quality, scd2
from dimflow.params import RunParams
from dimflow.plans.daily_run import (
    Inputs,
    Outputs,
    Targets,
    audit,
    inputs_from_catalog,
    inputs_from_store,
    plan,
    publish,
    publish_audited,
    publish_catalog,
)
from dimflow.session import materialize, scratch_path
from dimflow.sinks import ordered, writers
from dimflow.sources import feeds
from dimflow.sources import fixtures as fx
from dimflow.sources.catalog import CatalogMart
from dimflow.sources.dimension import DimensionStore, current_rows

Query = Callable[[SparkSession, str], DataFrame]

# Fixed run of the test data: business date, open-ended date and a pinned audit time.
PARAMS = RunParams(run_date=dt.date(2026, 7, 28), high_date=dt.date(9999, 12, 31),
                   run_ts="2026-07-28 00:00:00")
IDS = ["TXN_ID", "CUST_ID"]

REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def fixture_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(customer_delta=fx.customer_delta(spark, sf_dir), sales_txn=fx.sales_txn(spark, sf_dir),
                  dimension=fx.dimension(spark, sf_dir))


def run(spark: SparkSession, sf_dir: str, params: RunParams = PARAMS) -> Outputs:
    return plan(fixture_inputs(spark, sf_dir), params)


def _targets(spark: SparkSession, store: DimensionStore) -> Targets:
    return Targets(dimension_root=store.root, fact_path=scratch_path(spark, "fact"),
                   error_dir=scratch_path(spark, "errors"))


def _enriched_pre_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.enrich(fx.sales_txn(spark, sf_dir), fx.dim_current(spark, sf_dir), S.CUSTOMER_ID, PARAMS)


def _change_set(spark: SparkSession, sf_dir: str, params: RunParams = PARAMS) -> DataFrame:
    return changes.capture_changes(fx.customer_delta(spark, sf_dir), fx.dim_current(spark, sf_dir), params)


def _keyed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    change_set = _change_set(spark, sf_dir)
    base = keys.key_base(fx.dimension(spark, sf_dir), S.CUSTOMER_KEY)
    needs_key = change_set.filter(change_set.CHANGE_CODE.isin(S.INSERT, S.EDIT))
    return keys.assign_keys(needs_key, scd2.key_order(), base, S.CUSTOMER_KEY)


# ---- sources (S1-S5) -----------------------------------------------------------------------------

@query("scan_customer_delta_csv")
def scan_customer_delta_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = scratch_path(spark, "feeds")
    feeds.write_feed(fx.customer_delta(spark, sf_dir), feeds.feed_path(src, "customer_delta", PARAMS.run_date))
    return feeds.read_customer_delta(spark, src, PARAMS.run_date)


@query("scan_sales_csv")
def scan_sales_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = scratch_path(spark, "feeds")
    feeds.write_feed(fx.sales_txn(spark, sf_dir), feeds.feed_path(src, "sales_txn", PARAMS.run_date))
    return feeds.read_sales_txn(spark, src, PARAMS.run_date)


@query("dim_current_scan")
def dim_current_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current-row scan of a dimension holding both flags, stored partitioned by flag."""
    path = scratch_path(spark, "dim_by_flag")
    run(spark, sf_dir).dimension_after.write.partitionBy("CURR_FLAG").parquet(path)
    return current_rows(spark.read.parquet(path))


@query("dim_bootstrap_first_load")
def dim_bootstrap_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run against a target that does not exist yet: every feed row is an insert."""
    store = DimensionStore(scratch_path(spark, "dim_store"))
    inputs = inputs_from_store(fx.customer_delta(spark, sf_dir), fx.sales_txn(spark, sf_dir), store, PARAMS)
    publish(plan(inputs, PARAMS), _targets(spark, store), PARAMS)
    return store.read_all(spark)


# ---- lookup (J1, J2) -----------------------------------------------------------------------------

@query("lookup_enrich")
def lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched_pre_load(spark, sf_dir)


@query("lookup_reject")
def lookup_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.unmatched(fx.sales_txn(spark, sf_dir), fx.dim_current(spark, sf_dir), S.CUSTOMER_ID,
                            S.CUSTOMER_NOT_FOUND, PARAMS, IDS)


@query("lookup_enrich_post_load")
def lookup_enrich_post_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).enriched


@query("lookup_reject_post_load")
def lookup_reject_post_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).lookup_rejects


# ---- data quality (P3-P5, D1, D2, E1) ------------------------------------------------------------

@query("dq_pass")
def dq_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.passed(_enriched_pre_load(spark, sf_dir), quality.sales_rules())


@query("dq_reject")
def dq_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected(_enriched_pre_load(spark, sf_dir), quality.sales_rules(), IDS)


@query("dq_reject_unjoined")
def dq_reject_unjoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules on the sales themselves, before any lookup: rows without a customer id are rejected for that."""
    return quality.rejected(fx.sales_txn(spark, sf_dir), quality.sales_rules(), IDS)


@query("dq_unclassified")
def dq_unclassified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unclassified(_enriched_pre_load(spark, sf_dir), quality.sales_rules())


# ---- change capture, keys, SCD2 (C1-C4, W1, K1, K2, T1-T3, E2-E4) --------------------------------

@query("change_capture")
def change_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_set(spark, sf_dir)


@query("change_capture_null_safe")
def change_capture_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_set(spark, sf_dir, PARAMS.with_(null_safe_compare=True))


@query("change_capture_with_deletes")
def change_capture_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_set(spark, sf_dir, PARAMS.with_(detect_deletes=True))


@query("feed_latest_per_key")
def feed_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-latest dedupe of the customer feed by business key (option ``dedupe_feed``)."""
    return changes.latest_per_key(fx.customer_delta(spark, sf_dir), S.CUSTOMER_ID, "EFF_DATE")


@query("surrogate_keys")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_changes(spark, sf_dir)


@query("surrogate_keys_distributed")
def surrogate_keys_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers from the checkpointed change set, as the daily run assigns them."""
    base = keys.key_base(fx.dimension(spark, sf_dir), S.CUSTOMER_KEY)
    change_set = materialize(_change_set(spark, sf_dir))
    return keys.assign_keys(change_set.filter(change_set.CHANGE_CODE.isin(S.INSERT, S.EDIT)), scd2.key_order(), base,
                            S.CUSTOMER_KEY, stable_input=True)


@query("scd2_expire")
def scd2_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.expire(_change_set(spark, sf_dir), PARAMS)


@query("scd2_new_versions")
def scd2_new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = keys.key_base(fx.dimension(spark, sf_dir), S.CUSTOMER_KEY)
    return scd2.new_versions(_change_set(spark, sf_dir), base, PARAMS)


@query("dim_after_load")
def dim_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).dimension_after


def _seeded_store(spark: SparkSession, sf_dir: str) -> DimensionStore:
    """A versioned store that holds the dimension before the run."""
    store = DimensionStore(scratch_path(spark, "dim_store"))
    rows = fx.dimension(spark, sf_dir)
    writers.write_dimension_version(store, current_rows(rows), rows.filter(rows.CURR_FLAG == S.EXPIRED_FLAG),
                                    fx.DIM_EFF_DATE, keys.key_base(rows, S.CUSTOMER_KEY))
    return store


@query("dim_versioned_roundtrip")
def dim_versioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed a versioned store with the dimension, run the day from it, read it back."""
    store = _seeded_store(spark, sf_dir)
    inputs = inputs_from_store(fx.customer_delta(spark, sf_dir), fx.sales_txn(spark, sf_dir), store, PARAMS)
    publish(plan(inputs, PARAMS), _targets(spark, store), PARAMS)
    return store.read_all(spark)


def _two_days() -> list[tuple[dt.date, Callable[[SparkSession, str], DataFrame]]]:
    return [(PARAMS.run_date, fx.customer_delta), (PARAMS.run_date + dt.timedelta(days=1), fx.next_day_delta)]


@query("dim_two_day")
def dim_two_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days in a row from a seeded store, the latest feed row of each customer: expiry dates, keys carried on."""
    with fx.prepared(spark, sf_dir, "customer_delta", "sales_txn", "dimension") as given:
        store = _seeded_store(spark, given)
        for day, feed in _two_days():
            params = PARAMS.with_(run_date=day, dedupe_feed=True)
            inputs = inputs_from_store(feed(spark, given), fx.sales_txn(spark, given), store, params)
            publish(plan(inputs, params), _targets(spark, store), params)
    return store.read_all(spark)


def _catalog_days(spark: SparkSession, sf_dir: str) -> CatalogMart:
    """Two days in a row from an empty catalog."""
    folder = scratch_path(spark, "catalog")
    mart = CatalogMart("dimflow_" + folder.rsplit("-", 1)[1], folder)
    with fx.prepared(spark, sf_dir, "customer_delta", "sales_txn") as given:
        for day, feed in _two_days():
            params = PARAMS.with_(run_date=day, dedupe_feed=True)
            inputs = inputs_from_catalog(feed(spark, given), fx.sales_txn(spark, given), mart, params)
            publish_catalog(plan(inputs, params), mart, params)
    return mart


@query("dim_catalog_two_day")
def dim_catalog_two_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension's view after a first load into an empty catalog and a day on top of it."""
    return spark.table(_catalog_days(spark, sf_dir).dimension)


# ---- facts, errors, audit (A1-A5, O1, U1, N2, N3, M2-M4) -----------------------------------------

@query("sales_fact_aggregate")
def sales_fact_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.summarise(quality.passed(_enriched_pre_load(spark, sf_dir), quality.sales_rules()))


@query("sales_sorted")
def sales_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.sort_for_output(quality.passed(_enriched_pre_load(spark, sf_dir), quality.sales_rules()))


@query("sales_sorted_files")
def sales_sorted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted sales as a table of files in order, with the position at which a reader finds each row."""
    path = scratch_path(spark, "sales_sorted")
    passed = quality.passed(_enriched_pre_load(spark, sf_dir), quality.sales_rules())
    ordered.write_sorted(passed, path, S.FACT_SORT, fx.sales_tasks(spark, sf_dir))
    return ordered.read_sorted(spark, path, passed.schema)


@query("sales_fact_post_load")
def sales_fact_post_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).fact


@query("error_funnel")
def error_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).errors


@query("fact_append_roundtrip")
def fact_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    writers.write_fact(run(spark, sf_dir).fact, path, PARAMS.run_date, mode="append")
    return writers.read_fact(spark, path, PARAMS.run_date)


@query("error_log_roundtrip")
def error_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    err_dir = scratch_path(spark, "errors")
    writers.write_error_log(run(spark, sf_dir).errors, err_dir, PARAMS.run_date)
    return writers.read_error_log(spark, err_dir, PARAMS.run_date)


@query("load_audit")
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fixture_inputs(spark, sf_dir)
    return audit(inputs, plan(inputs, PARAMS))


@query("load_audit_observed")
def load_audit_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a whole run from the counts its writes observed: the sales are read once, by the run itself."""
    targets = _targets(spark, DimensionStore(scratch_path(spark, "dim_store")))
    return publish_audited(run(spark, sf_dir), targets, PARAMS)[1]
