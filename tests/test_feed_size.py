"""The sales feed at any size: tasks of a bounded number of line items, inputs of several days made once."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimflow.plans import queries
from dimflow.sources import fixtures as fx

ORDERS, LINES = 500, 8


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    many = range(ORDERS)
    made = {
        "region": {"r_regionkey": [0], "r_name": ["R"]},
        "nation": {"n_nationkey": [0], "n_name": ["N"], "n_regionkey": [0]},
        "supplier": {"s_name": ["S1"]},
        "part": {"p_partkey": [0, 1], "p_retailprice": [Decimal("9.50"), Decimal("3.25")]},
        "customer": {"c_custkey": list(range(50)), "c_name": [f"c{i}" for i in range(50)], "c_nationkey": [0] * 50,
                     "c_acctbal": [Decimal(i - 5) for i in range(50)], "c_mktsegment": ["MACHINERY", "OTHER"] * 25},
        "orders": {"o_orderkey": list(many), "o_custkey": [i % 60 for i in many],
                   "o_orderpriority": ["1-URGENT", "5-LOW"] * (ORDERS // 2),
                   "o_orderdate": [dt.date(1992 + i % 60 % 11, 5, 1) for i in many], "o_orderstatus": ["P", "O", "F", "F"] * (ORDERS // 4)},
        "lineitem": {"l_orderkey": [i for i in many for _ in range(LINES)], "l_linenumber": [*range(LINES)] * ORDERS,
                     "l_partkey": [0, 1] * (ORDERS * LINES // 2), "l_suppkey": [*range(LINES)] * ORDERS,
                     "l_quantity": [Decimal(3)] * (ORDERS * LINES), "l_extendedprice": [Decimal("12.75")] * (ORDERS * LINES)},
    }
    for name, columns in made.items():
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    return str(folder)


def test_a_task_holds_so_many_sales(spark, tables, monkeypatch):
    monkeypatch.setattr(fx, "ROWS", 500, raising=False)
    sizes = [r["count"] for r in fx.sales_txn(spark, tables).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == ORDERS * LINES and max(sizes) <= 1500
    out = queries.sales_sorted_files(spark, tables)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for f in out.inputFiles()]
    positions = sorted(r["POSITION"] for r in out.collect())
    assert positions == list(range(1, sum(files) + 1)) and len(files) >= 4 and max(files) <= 1500


@pytest.mark.parametrize("name", ["dim_two_day", "dim_catalog_two_day"])
def test_two_days_make_their_feed_once(spark, tables, monkeypatch, name):
    read = []
    real = fx.table
    monkeypatch.setattr(fx, "table", lambda s, d, t: read.append(t) or real(s, d, t))
    assert queries.REGISTRY[name](spark, tables).count() > 0
    assert read.count("part") == 1 and not fx._prepared & {tables}
