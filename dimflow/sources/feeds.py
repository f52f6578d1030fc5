"""Dated CSV feeds: ``<src_dir>/<name>_<yyyy-MM-dd>.dat`` with a header row.

Options match the original feeds: comma separated, UTF-8, the literal ``NULL``
for a null field, ``yyyy-MM-dd`` dates and a declared schema (no inference).
Parsing is PERMISSIVE like the original: a malformed value becomes NULL. An
empty unquoted field is also NULL, a quoted ``""`` stays an empty string.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dimflow import schemas as S

FEED_OPTIONS = {
    "header": "true",
    "sep": ",",
    "nullValue": "NULL",
    "encoding": "UTF-8",
    "dateFormat": "yyyy-MM-dd",
    "mode": "PERMISSIVE",
}


def feed_path(src_dir: str, name: str, run_date: dt.date) -> str:
    return f"{src_dir.rstrip('/')}/{name}_{run_date.isoformat()}.dat"


def read_feed(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType) -> DataFrame:
    """Scan one or many feed files (or directories of part files) with a fixed schema."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).options(**FEED_OPTIONS).csv(paths)


def read_customer_delta(spark: SparkSession, src_dir: str, run_dates: dt.date | Iterable[dt.date]) -> DataFrame:
    dates = [run_dates] if isinstance(run_dates, dt.date) else list(run_dates)
    return read_feed(spark, [feed_path(src_dir, "customer_delta", d) for d in dates], S.CUSTOMER_DELTA)


def read_sales_txn(spark: SparkSession, src_dir: str, run_dates: dt.date | Iterable[dt.date]) -> DataFrame:
    dates = [run_dates] if isinstance(run_dates, dt.date) else list(run_dates)
    return read_feed(spark, [feed_path(src_dir, "sales_txn", d) for d in dates], S.SALES_TXN)


def write_feed(df: DataFrame, path: str) -> None:
    """Write a frame in feed format (used to stage feeds and in round-trip tests)."""
    (df.write.mode("overwrite")
     .option("header", "true").option("nullValue", "NULL").option("dateFormat", "yyyy-MM-dd")
     .option("encoding", "UTF-8")
     .csv(path))
