"""Compare registered Spark queries with their DuckDB oracle SQL.

Same checks as the round driver: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        entry = {"rows": len(rows), "spark_s": round(t1 - t0, 2)}
        if name in sqls:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
            entry.update({
                "oracle_rows": len(orows),
                "schema_ok": sorted(cols) == sorted(ocols),
                "hash_ok": sorted(cols) == sorted(ocols) and digest(cols, rows) == digest(ocols, orows),
            })
        else:
            entry["oracle"] = "none"
        report[name] = entry
        print(name, entry, flush=True)
    return report


if __name__ == "__main__":
    from dimflow.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    compare(local_session(8), sf, only)
