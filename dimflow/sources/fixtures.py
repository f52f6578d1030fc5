"""Adapters that derive the mart's input feeds from the TPC-H-like test tables.

Each adapter is a plain DataFrame plan over the whole given parquet tables, so
its work grows with them. Which customers are new, known or inactive follows from
their orders:

* the dimension holds the customers first seen before ``KNOWN_BEFORE``; those with
  a negative balance have two current rows, those of one segment an expired
  version as well;
* the feed holds the customers seen since ``ACTIVE_SINCE`` and every customer the
  dimension does not know; those with an urgent order since then come twice, from
  two source systems; suppliers come as rows without a customer id.

Every customer is in at least one of the two. Values (not rows) are varied by
remainders of the keys: NULL transitions, edited segments, defects of sales.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.session import drop_scratch, scratch_path

HISTORY_DATE = dt.date(2025, 1, 1)
DIM_EFF_DATE = dt.date(2026, 1, 1)
FEED_EFF_DATE = dt.date(2026, 7, 1)
HIGH_DATE = dt.date(9999, 12, 31)
KNOWN_BEFORE = dt.date(1996, 1, 1)
ACTIVE_SINCE = dt.date(2001, 1, 1)
HISTORY_SEGMENT = "MACHINERY"
ROWS = 1 << 18  # line items in one task; later joins make their rows several times as wide

_prepared: set[str] = set()  # folders that hold the adapters' output


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _adapter(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``make``, or its output read back where ``sf_dir`` is a folder that :func:`prepare` wrote."""
    @wraps(make)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, make.__name__) if sf_dir in _prepared else make(spark, sf_dir)
    return read


def prepare(spark: SparkSession, sf_dir: str, folder: str,
            names: tuple[str, ...] = ("customer_delta", "sales_txn", "dimension")) -> str:
    """Write the inputs made from ``sf_dir`` (all three, or those of ``names``) to ``folder``, which may then stand for it."""
    for make in (m for m in (customer_delta, sales_txn, dimension) if m.__name__ in names):
        make(spark, sf_dir).write.mode("errorifexists").parquet(f"{folder.rstrip('/')}/{make.__name__}.parquet")
    _prepared.add(folder)
    return folder


@contextmanager
def prepared(spark: SparkSession, sf_dir: str, *names: str) -> Iterator[str]:
    """A folder that stands for ``sf_dir`` in a job that reads its inputs several times: they are made once, then dropped."""
    if sf_dir in _prepared:
        yield sf_dir
        return
    folder = prepare(spark, sf_dir, scratch_path(spark, "inputs"), names)
    try:
        yield folder
    finally:
        _prepared.discard(folder)
        drop_scratch(spark, folder)


def _txt(c: Column | str) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with nation, region and the dates of the first and last order."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    day = F.col("o_orderdate").cast("date")
    seen = (table(spark, sf_dir, "orders").groupBy("o_custkey")
            .agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"),
                 F.max((F.col("o_orderpriority") == "1-URGENT") & (day >= F.lit(ACTIVE_SINCE))).alias("urgent")))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .join(seen, customer.c_custkey == seen.o_custkey, "left")
        .withColumn("known", F.coalesce(F.col("first_seen") < F.lit(KNOWN_BEFORE), F.lit(True)))
    )


def _address(key: Column, null_every: int) -> Column:
    return F.when(key % null_every == 0, F.lit(None).cast("string")).otherwise(
        F.concat(_txt(key), F.lit(" Main St")))


def sales_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the sales feed, ``ROWS`` line items in each; the count comes from the Parquet footers."""
    lines = table(spark, sf_dir, "sales_txn" if sf_dir in _prepared else "lineitem")
    return max(1, -(-lines.count() // ROWS))


@_adapter
def sales_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales feed: one transaction per line item, with planted defects.

    The line items are dealt into tasks of about ``ROWS``, however many there are and whatever is broadcast to them.
    """
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate",
                                              "o_orderstatus")
    unnamed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    ok = F.col("l_orderkey")
    amount = F.col("l_extendedprice").cast("decimal(14,2)")
    tasks = sales_tasks(spark, sf_dir)
    if tasks > 1:
        l, o = l.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    return (
        l.join(o, l.l_orderkey == o.o_orderkey)
        .join(p, l.l_partkey == p.p_partkey)
        .select(
            F.concat(F.lit("TXN-"), _txt(ok), F.lit("-"), _txt("l_linenumber"), F.lit("-"),
                     _txt("l_partkey")).alias("TXN_ID"),
            F.when(~unnamed, F.concat(F.lit("CUST"), _txt("o_custkey"))).alias("CUST_ID"),
            F.concat(F.lit("PROD-"), _txt(F.col("l_partkey") % 3)).alias("PRODUCT_ID"),
            F.when(F.col("l_suppkey") % 5 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("STORE-"), _txt(F.col("l_suppkey") % 10))).alias("STORE_ID"),
            F.col("o_orderpriority").alias("CHANNEL"),
            F.when(ok % 31 == 0, F.lit(None).cast("date"))
            .otherwise(F.date_trunc("year", "o_orderdate").cast("date")).alias("TXN_DATE"),
            F.when(ok % 29 == 0, F.lit(0))
            .when(ok % 37 == 0, F.lit(None).cast("int"))
            .otherwise(F.col("l_quantity").cast("int")).alias("QTY"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("UNIT_PRICE"),
            F.when(ok % 23 == 0, -amount)
            .when(ok % 41 == 0, F.lit(None).cast("decimal(14,2)"))
            .otherwise(amount).alias("AMOUNT"),
        )
    )


@_adapter
def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension before the run: current rows and expired versions."""
    key = F.col("c_custkey")
    second = F.when(F.col("c_acctbal") < 0, F.lit(2))
    expired = F.when(F.col("c_mktsegment") == F.lit(HISTORY_SEGMENT), F.lit(3))
    version = F.explode(F.array_compact(F.array(F.lit(1), second, expired))).alias("version")
    rows = _customers(spark, sf_dir).filter("known").select("*", version)
    old = F.col("version") == 3
    return rows.select(
        (key * 3 + F.col("version")).cast("int").alias("CUST_KEY"),
        F.concat(F.lit("CUST"), _txt(key)).alias("CUST_ID"),
        F.when(F.col("version") == 2, F.concat("c_name", F.lit(" (2)"))).otherwise(F.col("c_name")).alias("CUST_NAME"),
        _address(key, 13).alias("ADDRESS"),
        F.col("n_name").alias("CITY"),
        F.col("r_name").alias("STATE"),
        _txt(F.lit(10000) + key % 90000).alias("ZIP"),
        F.when(old, F.lit("FORMER")).otherwise(F.col("c_mktsegment")).alias("SEGMENT"),
        F.when(old, F.lit(HISTORY_DATE)).otherwise(F.lit(DIM_EFF_DATE)).alias("EFF_DATE"),
        F.when(old, F.date_sub(F.lit(DIM_EFF_DATE), 1)).otherwise(F.lit(HIGH_DATE)).alias("EXP_DATE"),
        F.when(old, F.lit(S.EXPIRED_FLAG)).otherwise(F.lit(S.CURRENT_FLAG)).alias("CURR_FLAG"),
    )


def dim_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of the dimension before the run (some customers have two)."""
    return dimension(spark, sf_dir).filter(F.col("CURR_FLAG") == F.lit(S.CURRENT_FLAG))


@_adapter
def customer_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer feed of the run date: new, edited and unchanged customers, some twice, and rows without a customer id."""
    key = F.col("c_custkey")
    active = F.coalesce(F.col("last_seen") >= F.lit(ACTIVE_SINCE), F.lit(False))
    system = F.explode(F.array_compact(F.array(F.lit("CRM"), F.when(F.coalesce("urgent", F.lit(False)), F.lit("WEB")))))
    rows = _customers(spark, sf_dir).filter(active | ~F.col("known")).select("*", system.alias("system"))
    web = F.col("system") == "WEB"
    customers = rows.select(
        F.concat(F.lit("CUST"), _txt(key)).alias("CUST_ID"),
        F.col("c_name").alias("CUST_NAME"),
        _address(key, 17).alias("ADDRESS"),
        F.col("n_name").alias("CITY"),
        F.col("r_name").alias("STATE"),
        _txt(F.lit(10000) + key % 90000).alias("ZIP"),
        F.when(key % 7 == 0, F.lit("CHANGED")).when(web & (key % 5 == 0), F.lit("ONLINE"))
        .otherwise(F.col("c_mktsegment")).alias("SEGMENT"),
        F.col("system").alias("SOURCE_SYSTEM"),
        F.when(web, F.date_sub(F.lit(FEED_EFF_DATE), 7)).otherwise(F.lit(FEED_EFF_DATE)).alias("EFF_DATE"),
    )
    nobody = F.lit(None).cast("string")
    suppliers = table(spark, sf_dir, "supplier").select(
        nobody.alias("CUST_ID"), F.col("s_name").alias("CUST_NAME"), nobody.alias("ADDRESS"), nobody.alias("CITY"),
        nobody.alias("STATE"), nobody.alias("ZIP"), F.lit("SUPPLIER").alias("SEGMENT"),
        F.lit("ERP").alias("SOURCE_SYSTEM"), F.lit(FEED_EFF_DATE).alias("EFF_DATE"))
    return customers.unionByName(suppliers)


def next_day_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of the following day: the same customers, some of them in another segment."""
    raised = F.col("CUST_ID").endswith("5")
    return customer_delta(spark, sf_dir).withColumn("SEGMENT", F.when(raised, F.lit("RAISED")).otherwise(F.col("SEGMENT")))
