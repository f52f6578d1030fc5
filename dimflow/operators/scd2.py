"""SCD Type 2 maintenance.

* ``expire``        — for every edit, close the existing version:
                      ``(CUST_KEY, CURR_FLAG='N', EXP_DATE = run_date - 1)``.
* ``new_versions``  — inserts and edits, numbered once over their union in key
                      order, open from ``run_date`` to ``high_date``.
* ``apply_to_dimension`` — the whole dimension after the run, as one set-based
                      plan: dimension LEFT JOIN expire (by surrogate key), UNION new.
* ``current_after`` — only the current rows after the run (what lookups need).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.functions import date_lit, day_before
from dimflow.operators.joins import LookupPlan, Size, lookup_join, plan_lookup
from dimflow.operators.keys import assign_keys
from dimflow.params import RunParams

EXISTING_KEY = "EXISTING_CUST_KEY"
DIM_COLUMNS = S.names(S.CUSTOMER_DIM)


def expire(changes: DataFrame, params: RunParams) -> DataFrame:
    return (
        changes.filter(F.col("CHANGE_CODE").isin(S.EDIT, S.DELETE))
        .select(
            F.col(EXISTING_KEY).alias(S.CUSTOMER_KEY),
            F.lit(S.EXPIRED_FLAG).alias("CURR_FLAG"),
            day_before(params.run_date).alias("EXP_DATE"),
        )
    )


def key_order(attributes: list[str] | None = None) -> list[str]:
    """Business key first; the remaining columns only break ties between duplicate keys."""
    return [S.CUSTOMER_ID, *(attributes or S.TRACKED_ATTRIBUTES), EXISTING_KEY]


def new_versions(changes: DataFrame, base_key: int, params: RunParams, stable_input: bool = False) -> DataFrame:
    """``stable_input`` — ``changes`` reads a checkpoint (as in the daily run)."""
    needs_key = changes.filter(F.col("CHANGE_CODE").isin(S.INSERT, S.EDIT))
    keyed = assign_keys(needs_key, key_order(), base_key, S.CUSTOMER_KEY, stable_input)
    return keyed.select(
        S.CUSTOMER_KEY, S.CUSTOMER_ID, *S.TRACKED_ATTRIBUTES, EXISTING_KEY,
        F.lit(S.CURRENT_FLAG).alias("CURR_FLAG"),
        date_lit(params.run_date).alias("EFF_DATE"),
        date_lit(params.high_date).alias("EXP_DATE"),
    )


def apply_to_dimension(dim: DataFrame, expired: DataFrame, new: DataFrame, params: RunParams,
                       expired_size: Size | None = None) -> DataFrame:
    """Dimension after the run: expired versions closed, new versions appended.

    Updating the same key twice is idempotent in the original, so the expire set
    is de-duplicated before the key match (no row multiplication).
    """
    closing = expired.select(
        S.CUSTOMER_KEY, F.col("CURR_FLAG").alias("_new_flag"), F.col("EXP_DATE").alias("_new_exp")).distinct()
    updated = (
        lookup_join(dim.select(*DIM_COLUMNS), closing, S.CUSTOMER_KEY, "left", params, expired_size)
        .withColumn("CURR_FLAG", F.coalesce("_new_flag", "CURR_FLAG"))
        .withColumn("EXP_DATE", F.coalesce("_new_exp", "EXP_DATE"))
        .select(*DIM_COLUMNS)
    )
    return updated.unionByName(new.select(*DIM_COLUMNS))


def closing_plan(dim_current: DataFrame, expired: DataFrame, params: RunParams,
                 expired_size: Size | None = None) -> LookupPlan:
    """One join plan of the current rows with the keys this run closes, shared by
    :func:`newly_expired` and :func:`current_after`."""
    closing = expired.select(S.CUSTOMER_KEY).distinct()
    return plan_lookup(dim_current.select(*DIM_COLUMNS), closing, S.CUSTOMER_KEY, params, expired_size)


def newly_expired(dim_current: DataFrame, expired: DataFrame, params: RunParams,
                  expired_size: Size | None = None, plan: LookupPlan | None = None) -> DataFrame:
    """Current versions closed by this run, with their new flag and end date."""
    plan = plan or closing_plan(dim_current, expired, params, expired_size)
    return (
        plan.join(dim_current.select(*DIM_COLUMNS), "left_semi", [])
        .withColumn("CURR_FLAG", F.lit(S.EXPIRED_FLAG))
        .withColumn("EXP_DATE", day_before(params.run_date))
        .select(*DIM_COLUMNS)
    )


def current_after(dim_current: DataFrame, expired: DataFrame, new: DataFrame, params: RunParams,
                  expired_size: Size | None = None, plan: LookupPlan | None = None) -> DataFrame:
    """Current rows after the run: untouched current rows plus the new versions."""
    plan = plan or closing_plan(dim_current, expired, params, expired_size)
    kept = plan.join(dim_current.select(*DIM_COLUMNS), "left_anti", [])
    return kept.unionByName(new.select(*DIM_COLUMNS))
