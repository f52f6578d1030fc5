"""Lookup enrichment with a reject output.

``enrich`` keeps rows whose key finds a reference row and appends the reference
columns: an inner join, so a NULL key never matches and a key with several
reference rows fans out. ``unmatched`` is the reject stream: a left anti join,
tagged with a reason. Both use one :class:`LookupPlan`, which broadcasts the
reference only under a proven size bound and is decided once for the pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.operators.joins import LookupPlan, plan_lookup
from dimflow.params import RunParams


def enrich(df: DataFrame, ref: DataFrame, on: str, params: RunParams,
           ref_columns: list[str] | None = None, plan: LookupPlan | None = None) -> DataFrame:
    """Matched rows: ``df`` columns followed by the reference columns (key once)."""
    cols = [c for c in (ref_columns or ref.columns) if c != on]
    plan = plan or plan_lookup(df, ref, on, params)
    return plan.join(df, "inner", cols).select(*df.columns, *cols)


def unmatched(df: DataFrame, ref: DataFrame, on: str, reason: str, params: RunParams,
              id_columns: list[str] | None = None, plan: LookupPlan | None = None) -> DataFrame:
    """Rows whose key has no reference row, projected to ids plus ``ERROR_REASON``."""
    ids = id_columns or df.columns
    plan = plan or plan_lookup(df, ref, on, params)
    return plan.join(df, "left_anti", []).select(*ids, F.lit(reason).alias("ERROR_REASON"))
