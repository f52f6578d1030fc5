"""DataFrame operators of the mart load; each takes column names as arguments."""

from dimflow.operators.changes import capture_changes, latest_per_key
from dimflow.operators.errors import funnel, rejects_in_one_pass
from dimflow.operators.facts import sort_for_output, summarise
from dimflow.operators.joins import (
    KeyProfile, LookupPlan, Size, fits_broadcast, hot_keys, profile_keys, lookup_join, measure, plan_lookup, salted_join,
)
from dimflow.operators.keys import assign_keys, key_base, positions_distributed
from dimflow.operators.lookup import enrich, unmatched
from dimflow.operators.quality import Rule, passed, rejected, sales_rules, split, unclassified
from dimflow.operators.scd2 import apply_to_dimension, closing_plan, current_after, expire, new_versions, newly_expired

__all__ = [
    "KeyProfile",
    "LookupPlan",
    "Rule",
    "Size",
    "apply_to_dimension",
    "assign_keys",
    "capture_changes",
    "closing_plan",
    "current_after",
    "enrich",
    "expire",
    "fits_broadcast",
    "funnel",
    "hot_keys",
    "key_base",
    "latest_per_key",
    "lookup_join",
    "measure",
    "new_versions",
    "newly_expired",
    "passed",
    "plan_lookup",
    "profile_keys",
    "positions_distributed",
    "rejected",
    "rejects_in_one_pass",
    "salted_join",
    "sales_rules",
    "sort_for_output",
    "split",
    "summarise",
    "unclassified",
    "unmatched",
]
