"""Periodic-summary fact aggregation (A1-A4) and the optional ordering (O1).

``summarise`` groups at the fact grain (NULL is a group of its own) with sum of
quantity, sum of amount, count of transaction ids and the plain mean of the unit
price, then narrows to the fact column types explicitly (HALF_UP on decimals;
ANSI mode raises rather than wrapping an int overflow). Spark plans it as a
partial aggregate before the shuffle, so a hot group is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow import schemas as S


def summarise(df: DataFrame, grain: list[str] | None = None) -> DataFrame:
    grain = grain or S.FACT_GRAIN
    return df.groupBy(*grain).agg(
        F.sum("QTY").cast("int").alias("TOTAL_QTY"),
        F.sum("AMOUNT").cast("decimal(15,2)").alias("TOTAL_AMOUNT"),
        F.count("TXN_ID").cast("int").alias("TXN_COUNT"),
        F.avg("UNIT_PRICE").cast("decimal(12,2)").alias("AVG_UNIT_PRICE"),
    )


def sort_for_output(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Ascending multi-key sort (NULLs first). Only worth it for ordered output:
    an aggregate after it ignores the order (Catalyst removes such a sort)."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in (keys or S.FACT_SORT)])
