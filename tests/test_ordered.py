"""Sorted tables: the order is in the files, no key is held together, equal rows keep their places."""

from __future__ import annotations

import datetime as dt
import glob
import re
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.sinks.ordered import POSITION, _number, read_sorted, with_place, write_sorted
from dimflow.sinks.writers import commit_fact, read_fact, stage_fact


def by_file(path):
    """The rows of each file, files by the number of their task."""
    files = sorted(glob.glob(f"{path}/part-*.parquet"), key=lambda f: int(re.search(r"part-(\d+)", f)[1]))
    return [[tuple(r.values()) for r in pq.ParquetFile(f).read().to_pylist()] for f in files]


def nulls_first(row):
    return tuple((v is not None, v) for v in row)


def mixed(spark, n=20_000):
    """A third of the rows under one key, some without a key, many rows that repeat."""
    return spark.range(0, n, 1, 7).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        (F.col("id") % 40).cast("int").alias("a b"), F.when(F.col("id") % 9 > 0, F.col("id") % 5).alias("c.d"))


def test_files_are_in_order(spark, workdir):
    df = mixed(spark)
    write_sorted(df, f"{workdir}/t", ["k", "c.d"], partitions=9)
    files = by_file(f"{workdir}/t")
    rows = [(k, c, a) for file in files for k, a, c in file]
    assert rows == sorted(((r[0], r[2], r[1]) for r in df.collect()), key=nulls_first)
    assert len(files) == 9 and max(map(len, files)) < 2 * len(rows) / 9


def test_positions_are_those_of_the_files(spark, workdir):
    df = mixed(spark, 3000)
    write_sorted(df, f"{workdir}/t", ["k", "c.d"], partitions=6)
    got = [tuple(r) for r in read_sorted(spark, f"{workdir}/t", df.schema).orderBy(POSITION).collect()]
    assert [r[:3] for r in got] == [r for file in by_file(f"{workdir}/t") for r in file]
    assert [r[3] for r in got] == list(range(1, 3001))


def test_one_row_repeated_spreads(spark, workdir):
    df = spark.range(0, 30_000, 1, 5).select(F.lit("x").alias("k"), F.lit(None).cast("int").alias("v"))
    write_sorted(df, f"{workdir}/t", ["k"], partitions=8)
    sizes = [len(f) for f in by_file(f"{workdir}/t")]
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 8


def test_a_repeated_task_gives_equal_rows_the_same_places(spark):
    """Two attempts of the tasks, one with the rows of each partition in another order: the ranges take the same rows."""
    first = mixed(spark, 4000)
    second = spark.createDataFrame(first.rdd.mapPartitions(lambda rows: reversed(list(rows))), first.schema)
    order = [F.col("k"), F.col("`a b`"), F.col("`c.d`")]
    one, two = (sorted((tuple(r) for r in with_place(df, order).collect()), key=nulls_first) for df in (first, second))
    assert one == two


def test_empty_and_refused(spark, workdir):
    none = spark.createDataFrame([], "k string, v int")
    write_sorted(none, f"{workdir}/none", ["v"])
    assert read_sorted(spark, f"{workdir}/none", none.schema).collect() == []
    with pytest.raises(ValueError):
        write_sorted(none.withColumn("position", F.lit(1)), f"{workdir}/a", ["v"])
    with pytest.raises(ValueError):
        write_sorted(none.select("k", "k"), f"{workdir}/b", ["k"])
    with pytest.raises(ValueError):
        write_sorted(none, f"{workdir}/c", ["v", "w"])
    with pytest.raises(ValueError):
        write_sorted(none, f"{workdir}/d", ["v", "v"])


def test_file_numbers_are_numbers(spark):
    names = ["part-100000-x-c000.snappy.parquet", "part-99999-x-c000.snappy.parquet", "part-00002-x-c010.parquet",
             "part-00002-x-c1000.parquet", "part-00002-x-c002.parquet", "part-00001-x.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r.f for r in df.orderBy(*_number(F.col("f"))).collect()] == [names[i] for i in (5, 4, 2, 3, 1, 0)]


def test_several_files_of_one_task(spark, workdir):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        df = mixed(spark, 2500)
        write_sorted(df, f"{workdir}/t", ["k"], partitions=2)
        got = read_sorted(spark, f"{workdir}/t", df.schema).orderBy(POSITION).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(glob.glob(f"{workdir}/t/part-*.parquet")) == 26
    assert [(r[0], r[1], r[2]) for r in got] == sorted((tuple(r) for r in df.collect()), key=nulls_first)


def test_fact_files_in_order(spark, workdir):
    day = dt.date(2026, 7, 28)
    rows = [(i * 7919 % 500, f"P{i % 3}", None if i % 4 else "S", day, i, Decimal(i), 1, Decimal(1)) for i in range(500)]
    fact = spark.createDataFrame(rows, "CUST_KEY int, PRODUCT_ID string, STORE_ID string, TXN_DATE date, TOTAL_QTY int, "
                                       "TOTAL_AMOUNT decimal(15,2), TXN_COUNT int, AVG_UNIT_PRICE decimal(12,2)")
    staged = stage_fact(fact.repartition(5), f"{workdir}/fact", day, order=["CUST_KEY", "PRODUCT_ID"])
    commit_fact(spark, f"{workdir}/fact", staged)
    keys = [r[0] for file in by_file(f"{workdir}/fact/LOAD_DATE={day}/attempt={staged.attempt}") for r in file]
    assert keys == sorted(keys) and staged.rows == 500
    assert sorted(tuple(r)[:8] for r in read_fact(spark, f"{workdir}/fact").select(*S.names(S.SALES_FACT)).collect()) \
        == sorted(rows)
