"""Run one daily load from the command line (``spark-submit -m dimflow`` / ``python -m dimflow``).

    python -m dimflow --run-date 2026-07-28 --src-dir /feeds --dim-root /mart/customer_dim \
        --fact-path /mart/sales_fact --err-dir /mart/errors

The first run on an empty store needs ``--first-load``: a mistyped ``--dim-root`` is
then refused instead of numbering from key 1. With ``--jdbc-url`` the dimension and
the fact are tables of a database instead (``JDBC_PASSWORD`` names the password);
``--jdbc-create`` makes the tables that are not there. With ``--catalog-database``
they are Parquet tables of the session's catalog.

Every path option falls back to an environment variable (``RUN_DATE``, ``HIGH_DATE``,
``SRC_DIR``, ``ERR_DIR``, ``DIM_ROOT``, ``FACT_PATH``); the run date defaults to
today. Feeds are read from ``<src-dir>/customer_delta_<date>.dat`` and
``<src-dir>/sales_txn_<date>.dat``; the dimension lives in a versioned store.
Prints the observed row counts as one JSON line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession

from dimflow.params import RunParams
from dimflow.plans import Targets, inputs_from_store, plan, publish
from dimflow.plans.daily_run import JdbcTables, inputs_from_catalog, inputs_from_jdbc, publish_catalog, publish_jdbc
from dimflow.session import cluster_conf
from dimflow.sources import CatalogMart, DimensionStore, JdbcTarget, read_customer_delta, read_sales_txn
from dimflow.sources.jdbc import create_statements


def parse_args(argv: list[str]) -> argparse.Namespace:
    env = os.environ.get
    ap = argparse.ArgumentParser(prog="dimflow", description="Daily SCD2 dimension + fact + error-log load")
    ap.add_argument("--run-date", default=env("RUN_DATE", dt.date.today().isoformat()))
    ap.add_argument("--high-date", default=env("HIGH_DATE", "9999-12-31"))
    ap.add_argument("--src-dir", default=env("SRC_DIR"), required=env("SRC_DIR") is None)
    ap.add_argument("--err-dir", default=env("ERR_DIR"), required=env("ERR_DIR") is None)
    ap.add_argument("--dim-root", default=env("DIM_ROOT"))
    ap.add_argument("--fact-path", default=env("FACT_PATH"))
    ap.add_argument("--fact-mode", choices=["append", "replace_run"], default="append")
    ap.add_argument("--fact-order", default="", help="columns, comma separated, whose order the fact's files keep")
    ap.add_argument("--first-load", action="store_true", help="the store is expected to be empty")
    ap.add_argument("--snapshot", choices=["post_load", "pre_load"], default="post_load")
    ap.add_argument("--dedupe-feed", action="store_true")
    ap.add_argument("--null-safe-compare", action="store_true")
    ap.add_argument("--detect-deletes", action="store_true")
    ap.add_argument("--run-ts", default=None, help="audit time, 'yyyy-MM-dd HH:mm:ss'; default: now")
    ap.add_argument("--broadcast-max-rows", type=int, default=RunParams.broadcast_max_rows)
    ap.add_argument("--broadcast-max-bytes", type=int, default=RunParams.broadcast_max_bytes)
    ap.add_argument("--input-bytes", type=int, default=0, help="size of the sales feed; sizes the shuffles")
    ap.add_argument("--jdbc-url", default=env("JDBC_URL"))
    ap.add_argument("--jdbc-user", default=env("JDBC_USER", ""))
    ap.add_argument("--jdbc-dim-table", default='"CUSTOMER_DIM"')
    ap.add_argument("--jdbc-fact-table", default='"SALES_FACT"')
    ap.add_argument("--jdbc-commit-table", default='"LOAD_COMMIT"')
    ap.add_argument("--jdbc-partitions", type=int, default=32)
    ap.add_argument("--jdbc-create", action="store_true")
    ap.add_argument("--catalog-database", default=env("CATALOG_DATABASE"))
    args = ap.parse_args(argv)
    if not (args.jdbc_url or args.catalog_database) and not (args.dim_root and args.fact_path):
        ap.error("--dim-root and --fact-path are needed (or --jdbc-url, or --catalog-database)")
    return args


def session(args: argparse.Namespace, name: str) -> SparkSession:
    """A session in UTC with ANSI arithmetic (keys and totals raise on overflow), sized to the input."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    for key, value in cluster_conf(args.input_bytes).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> dict[str, int]:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    params = RunParams(run_date=args.run_date, high_date=args.high_date, snapshot=args.snapshot, run_ts=args.run_ts,
                       dedupe_feed=args.dedupe_feed, null_safe_compare=args.null_safe_compare,
                       detect_deletes=args.detect_deletes, broadcast_max_rows=args.broadcast_max_rows,
                       broadcast_max_bytes=args.broadcast_max_bytes)
    spark = session(args, f"dimflow-{params.run_tag}")
    feeds = (read_customer_delta(spark, args.src_dir, params.run_date),
             read_sales_txn(spark, args.src_dir, params.run_date))
    if args.jdbc_url:
        target = JdbcTarget(args.jdbc_url, args.jdbc_user, os.environ.get("JDBC_PASSWORD", ""))
        tables = JdbcTables(target, args.jdbc_dim_table, args.jdbc_fact_table, args.jdbc_commit_table,
                            args.jdbc_partitions)
        if args.jdbc_create:
            target.apply(spark, ((sql, -1) for sql in create_statements(tables.dimension, tables.fact, tables.commits)))
        outputs = plan(inputs_from_jdbc(*feeds, tables), params)
        counts = publish_jdbc(outputs, tables, args.err_dir, params)
    elif args.catalog_database:
        mart = CatalogMart(args.catalog_database)
        outputs = plan(inputs_from_catalog(*feeds, mart, params), params)
        counts = publish_catalog(outputs, mart, params)
    else:
        store = DimensionStore(args.dim_root)
        if not args.first_load and not store.markers(spark):
            raise SystemExit(f"no dimension at {args.dim_root}; pass --first-load to start one")
        outputs = plan(inputs_from_store(*feeds, store, params), params)
        targets = Targets(dimension_root=args.dim_root, fact_path=args.fact_path, error_dir=args.err_dir,
                          fact_mode=args.fact_mode, fact_order=tuple(filter(None, args.fact_order.split(","))))
        counts = publish(outputs, targets, params)
    counts.update({"changes": outputs.change_rows, "key_base": outputs.key_base, "run_date": params.run_tag})
    print(json.dumps(counts))
    return counts


if __name__ == "__main__":
    main()
