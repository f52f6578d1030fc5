"""Column-expression helpers: predicates, ordered CASE, change tests, typed literals."""

from dimflow.functions.expressions import (
    all_of,
    any_of,
    any_differs,
    audit_timestamp,
    date_lit,
    day_before,
    first_match,
)

__all__ = [
    "all_of",
    "any_of",
    "any_differs",
    "audit_timestamp",
    "date_lit",
    "day_before",
    "first_match",
]
