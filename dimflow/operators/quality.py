"""Declarative data-quality routing.

A rule names a reason and a predicate that is TRUE for a bad row. Under SQL
three-valued logic:

* pass     = every ``bad`` is FALSE        (NOT(NULL) is NULL, so a NULL fails to pass)
* reject   = some ``bad`` is TRUE          (reason = first TRUE rule, in rule order)
* unclassified = neither — e.g. a NULL amount on an otherwise valid row.

Reject is deliberately *not* ``NOT pass``: rows with a NULL measure and no other
defect belong to neither stream, exactly like the original job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions import all_of, any_of, first_match


@dataclass(frozen=True)
class Rule:
    reason: str
    bad: Column


def sales_rules() -> list[Rule]:
    """The sales checks, in the order their reasons take precedence."""
    # Reject reasons of the original job.
    return [
        Rule("MISSING_CUST_ID", F.col("CUST_ID").isNull()),
        Rule("NON_POSITIVE_AMOUNT", F.col("AMOUNT") <= 0),
        Rule("NON_POSITIVE_QTY", F.col("QTY") <= 0),
        Rule("MISSING_TXN_DATE", F.col("TXN_DATE").isNull()),
    ]


def pass_predicate(rules: list[Rule]) -> Column:
    return all_of(*[~r.bad for r in rules])


def reject_predicate(rules: list[Rule]) -> Column:
    return any_of(*[r.bad for r in rules])


def reason(rules: list[Rule]) -> Column:
    """First rule that fires; the last reason is the fallback, as in the original CASE."""
    return first_match([(r.bad, r.reason) for r in rules[:-1]], rules[-1].reason)


def passed(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.filter(pass_predicate(rules))


def rejected(df: DataFrame, rules: list[Rule], id_columns: list[str]) -> DataFrame:
    return df.filter(reject_predicate(rules)).select(*id_columns, reason(rules).alias("ERROR_REASON"))


def unclassified(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows in neither stream (three-valued logic leaves them out of both)."""
    return df.filter(~F.coalesce(pass_predicate(rules), F.lit(False))
                     & ~F.coalesce(reject_predicate(rules), F.lit(False)))


def split(df: DataFrame, rules: list[Rule], id_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(pass, reject)`` — the pair the original validation stage returns."""
    return passed(df, rules), rejected(df, rules, id_columns)
