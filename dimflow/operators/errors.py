"""Error funnel (U1): every reject stream in one log with audit columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.functions import audit_timestamp, date_lit
from dimflow.operators.joins import LookupPlan, plan_lookup
from dimflow.operators.quality import Rule, reason, reject_predicate
from dimflow.params import RunParams


def funnel(*rejects: DataFrame, params: RunParams) -> DataFrame:
    """UNION ALL of the rejects (by name, 3 columns) + ERROR_TIMESTAMP + RUN_DATE."""
    streams = [r.select(*S.REJECT_COLUMNS) for r in rejects]
    union = reduce(lambda a, b: a.unionByName(b), streams)
    return union.select(
        *S.REJECT_COLUMNS,
        audit_timestamp(params.run_ts).alias("ERROR_TIMESTAMP"),
        date_lit(params.run_date).alias("RUN_DATE"),
    )


def rejects_in_one_pass(df: DataFrame, ref: DataFrame, on: str, key: str, not_found: str, rules: list[Rule],
                        params: RunParams, id_columns: list[str] | None = None,
                        plan: LookupPlan | None = None) -> DataFrame:
    """Lookup rejects and data-quality rejects from a single left join.

    A row whose key finds no reference row is rejected with ``not_found``; a
    matched row (once per matching reference row, like the enriched stream) is
    rejected when a rule fires. Same rows as ``unmatched`` UNION ALL
    ``rejected(enrich(...))`` but the input is scanned and joined once.
    """
    plan = plan or plan_lookup(df, ref, on, params)
    return rejects_from_joined(plan.join(df, "left", [key]), key, not_found, rules, id_columns)


def rejects_from_joined(joined: DataFrame, key: str, not_found: str, rules: list[Rule],
                        id_columns: list[str] | None = None) -> DataFrame:
    """The rejects of :func:`rejects_in_one_pass` from an existing left join that carries ``key``."""
    ids = id_columns or S.REJECT_COLUMNS[:2]
    missing = F.col(key).isNull()
    return (
        joined.filter(missing | F.coalesce(reject_predicate(rules), F.lit(False)))
        .select(*ids, F.when(missing, F.lit(not_found)).otherwise(reason(rules)).alias("ERROR_REASON"))
    )
