"""Built-in Spark column expressions only — everything here stays inside codegen."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(*conds: Column) -> Column:
    """Conjunction under SQL three-valued logic (NULL is not TRUE)."""
    return reduce(lambda a, b: a & b, conds)


def any_of(*conds: Column) -> Column:
    """Disjunction under SQL three-valued logic."""
    return reduce(lambda a, b: a | b, conds)


def first_match(cases: list[tuple[Column, Column | str]], default: Column | str | None) -> Column:
    """Ordered CASE: the first condition that is TRUE wins, else ``default``."""
    (cond, value), rest = cases[0], cases[1:]
    expr = F.when(cond, _lit(value))
    for cond, value in rest:
        expr = expr.when(cond, _lit(value))
    return expr.otherwise(_lit(default)) if default is not None else expr


def any_differs(pairs: list[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """TRUE when some pair differs.

    Default semantics are plain ``!=``: a pair with a NULL side is never a
    difference (NULL -> value is not an edit). ``null_safe`` compares with
    ``<=>`` so NULL -> value and value -> NULL count as differences.
    """
    if null_safe:
        tests = [~a.eqNullSafe(b) for a, b in pairs]
    else:
        tests = [a != b for a, b in pairs]
    return F.coalesce(any_of(*tests), F.lit(False))


def date_lit(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def day_before(value: dt.date) -> Column:
    return F.date_sub(date_lit(value), 1)


def audit_timestamp(run_ts: str | None) -> Column:
    """Pinned audit time (interpreted in the session time zone) or the query time."""
    if run_ts is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(run_ts))


def _lit(value):
    return value if isinstance(value, Column) else F.lit(value)
