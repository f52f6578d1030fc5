"""Change capture of a customer feed against the current dimension.

Each feed row is compared with the current row(s) of its business key:

* code 1 (insert) — no current row;
* code 3 (edit)   — some tracked attribute differs (plain ``!=`` by default, so
  NULL -> value is not an edit; ``null_safe`` counts it);
* code 0 (copy)   — otherwise; copies are dropped.

Current rows absent from the feed are kept as they are (no deletes), so the
compare join is a left join from the feed. With ``detect_deletes`` the result is
that of a full outer join: a current row missing from the feed yields code 2.
It is built as the left join plus an anti join of the current rows with the
feed's distinct keys, so a hot feed key is salted like any lookup and a large
dimension is scanned, not shuffled.

Output: CHANGE_CODE, key, the feed's attribute values, EXISTING_CUST_KEY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.functions import any_differs
from dimflow.operators.joins import Size, lookup_join
from dimflow.params import RunParams

BEFORE = "_before_"


def latest_per_key(feed: DataFrame, key: str, order_first: str) -> DataFrame:
    """Keep one row per key: the greatest ``order_first`` value, ties by the other columns.

    A grouped ``max`` over a struct is aggregated map-side first, so a key that
    holds a large share of the feed does not land in one task.
    """
    others = [c for c in feed.columns if c not in (key, order_first)]
    best = F.max(F.struct(F.col(order_first), *[F.col(c) for c in others])).alias("_best")
    return (feed.groupBy(key).agg(best)
            .select(key, *[F.col(f"_best.{c}").alias(c) for c in [order_first, *others]])
            .select(*feed.columns))


def capture_changes(feed: DataFrame, current: DataFrame, params: RunParams,
                    key: str = S.CUSTOMER_ID, surrogate: str = S.CUSTOMER_KEY,
                    attributes: list[str] | None = None,
                    existing_key: str = "EXISTING_CUST_KEY",
                    current_size: Size | None = None) -> DataFrame:
    """``current_size`` — proven bound on ``current`` (any projection of it is no larger)."""
    attributes = attributes or S.TRACKED_ATTRIBUTES
    before = current.select(
        F.col(key), F.col(surrogate).alias(existing_key),
        *[F.col(a).alias(BEFORE + a) for a in attributes])
    after = feed.select(key, *attributes)

    joined = lookup_join(after, before, key, "left", params, current_size)
    differs = any_differs([(F.col(a), F.col(BEFORE + a)) for a in attributes], params.null_safe_compare)
    code = (
        F.when(F.col(existing_key).isNull(), F.lit(S.INSERT))
        .when(differs, F.lit(S.EDIT))
        .otherwise(F.lit(S.COPY))
    )
    changed = joined.select(code.alias("CHANGE_CODE"), F.col(key), *[F.col(a) for a in attributes],
                            F.col(existing_key))
    if params.detect_deletes:
        # The rows a full outer join adds to the left join: current rows whose key
        # is not in the feed. An anti join with the feed's distinct keys (a small
        # side, de-duplicated map-side) finds them without shuffling the dimension.
        feed_keys = after.select(key).dropna().distinct()
        gone = lookup_join(before, feed_keys, key, "left_anti", params)
        changed = changed.unionByName(gone.select(
            F.when(F.col(existing_key).isNull(), F.lit(S.INSERT)).otherwise(F.lit(S.DELETE)).alias("CHANGE_CODE"),
            F.col(key), *[F.col(BEFORE + a).alias(a) for a in attributes], F.col(existing_key)))
    return (
        changed.filter(F.col("CHANGE_CODE") != F.lit(S.COPY))
        .filter(F.col(key).isNotNull())
    )
