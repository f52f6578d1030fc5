"""Independent SQL statements of every registered query, runnable by DuckDB.

They are written from the job's specification (full outer compare join, left
join + NULL-key test for lookups, global ``row_number`` for keys), not from
the Spark operators, and inline the test adapters as CTEs over the raw tables.
"""

from __future__ import annotations

RUN_DATE = "DATE '2026-07-28'"
EXPIRY_DATE = "DATE '2026-07-27'"
HIGH_DATE = "DATE '9999-12-31'"
RUN_TS = "TIMESTAMP '2026-07-28 00:00:00'"

ADAPTERS = """
sales_txn AS (
  SELECT concat('TXN-', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR), '-',
                CAST(l.l_partkey AS VARCHAR)) AS TXN_ID,
         CASE WHEN NOT (o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW')
              THEN concat('CUST', CAST(o.o_custkey AS VARCHAR)) END AS CUST_ID,
         concat('PROD-', CAST(l.l_partkey % 3 AS VARCHAR)) AS PRODUCT_ID,
         CASE WHEN l.l_suppkey % 5 = 0 THEN NULL
              ELSE concat('STORE-', CAST(l.l_suppkey % 10 AS VARCHAR)) END AS STORE_ID,
         o.o_orderpriority AS CHANNEL,
         CASE WHEN l.l_orderkey % 31 = 0 THEN NULL
              ELSE CAST(date_trunc('year', o.o_orderdate) AS DATE) END AS TXN_DATE,
         CASE WHEN l.l_orderkey % 29 = 0 THEN 0 WHEN l.l_orderkey % 37 = 0 THEN NULL
              ELSE CAST(l.l_quantity AS INTEGER) END AS QTY,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS UNIT_PRICE,
         CASE WHEN l.l_orderkey % 23 = 0 THEN -CAST(l.l_extendedprice AS DECIMAL(14,2))
              WHEN l.l_orderkey % 41 = 0 THEN NULL
              ELSE CAST(l.l_extendedprice AS DECIMAL(14,2)) END AS AMOUNT
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
),
customers AS (
  SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name, o.urgent,
         coalesce(o.first_seen < DATE '1996-01-01', TRUE) AS known,
         coalesce(o.last_seen >= DATE '2001-01-01', FALSE) AS active
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_seen, max(CAST(o_orderdate AS DATE)) AS last_seen,
                    bool_or(o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) >= DATE '2001-01-01') AS urgent
             FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
),
dimension AS (
  SELECT CAST(3 * c_custkey + v AS INTEGER) AS CUST_KEY, concat('CUST', CAST(c_custkey AS VARCHAR)) AS CUST_ID,
         CASE WHEN v = 2 THEN concat(c_name, ' (2)') ELSE c_name END AS CUST_NAME,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat(CAST(c_custkey AS VARCHAR), ' Main St') END AS ADDRESS,
         n_name AS CITY, r_name AS STATE, CAST(10000 + c_custkey % 90000 AS VARCHAR) AS ZIP,
         CASE WHEN v = 3 THEN 'FORMER' ELSE c_mktsegment END AS SEGMENT,
         CASE WHEN v = 3 THEN DATE '2025-01-01' ELSE DATE '2026-01-01' END AS EFF_DATE,
         CASE WHEN v = 3 THEN DATE '2025-12-31' ELSE DATE '9999-12-31' END AS EXP_DATE,
         CASE WHEN v = 3 THEN 'N' ELSE 'Y' END AS CURR_FLAG
  FROM customers CROSS JOIN (VALUES (1), (2), (3)) AS versions(v)
  WHERE known AND (v = 1 OR (v = 2 AND c_acctbal < 0) OR (v = 3 AND c_mktsegment = 'MACHINERY'))
),
dim_current AS (SELECT * FROM dimension WHERE CURR_FLAG = 'Y'),
customer_delta AS (
  SELECT concat('CUST', CAST(c_custkey AS VARCHAR)) AS CUST_ID, c_name AS CUST_NAME,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE concat(CAST(c_custkey AS VARCHAR), ' Main St') END AS ADDRESS,
         n_name AS CITY, r_name AS STATE, CAST(10000 + c_custkey % 90000 AS VARCHAR) AS ZIP,
         CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' WHEN sys = 'WEB' AND c_custkey % 5 = 0 THEN 'ONLINE'
              ELSE c_mktsegment END AS SEGMENT,
         sys AS SOURCE_SYSTEM, CASE WHEN sys = 'WEB' THEN DATE '2026-06-24' ELSE DATE '2026-07-01' END AS EFF_DATE
  FROM customers CROSS JOIN (VALUES ('CRM'), ('WEB')) AS systems(sys)
  WHERE (active OR NOT known) AND (sys = 'CRM' OR urgent)
  UNION ALL
  SELECT NULL, s_name, NULL, NULL, NULL, NULL, 'SUPPLIER', 'ERP', DATE '2026-07-01' FROM supplier
)"""

ATTRS = ["CUST_NAME", "ADDRESS", "CITY", "STATE", "ZIP", "SEGMENT"]
DIM_COLS = ["CUST_KEY", "CUST_ID", *ATTRS, "EFF_DATE", "EXP_DATE", "CURR_FLAG"]
SALES_COLS = ["TXN_ID", "CUST_ID", "PRODUCT_ID", "STORE_ID", "CHANNEL", "TXN_DATE", "QTY", "UNIT_PRICE", "AMOUNT"]
KEY_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ["CUST_ID", *ATTRS, "EXISTING_CUST_KEY"])


def _changes_cte(compare: str) -> str:
    # A current row absent from the feed is kept as it is (code 0). Plain `<>` gets
    # there by itself (NULL is never TRUE); the null-safe compare needs it spelled out.
    differs = " OR ".join(compare.format(c=c) for c in ATTRS)
    return f"""
change_all AS (
  SELECT CASE WHEN b.CUST_KEY IS NULL THEN 1 WHEN a.CUST_ID IS NULL THEN 0 WHEN {differs} THEN 3 ELSE 0 END
           AS CHANGE_CODE,
         COALESCE(a.CUST_ID, b.CUST_ID) AS CUST_ID,
         {", ".join(f"a.{c} AS {c}" for c in ATTRS)},
         b.CUST_KEY AS EXISTING_CUST_KEY
  FROM customer_delta a FULL OUTER JOIN dim_current b ON a.CUST_ID = b.CUST_ID
),
changes AS (SELECT * FROM change_all WHERE CHANGE_CODE <> 0 AND CUST_ID IS NOT NULL)"""


PLAIN_COMPARE = "a.{c} <> b.{c}"
NULL_SAFE_COMPARE = "a.{c} IS DISTINCT FROM b.{c}"

SCD = f"""
expire AS (
  SELECT EXISTING_CUST_KEY AS CUST_KEY, 'N' AS CURR_FLAG, {EXPIRY_DATE} AS EXP_DATE FROM changes WHERE CHANGE_CODE = 3
),
keyed AS (
  SELECT *, CAST((SELECT max(CUST_KEY) FROM dimension) + row_number() OVER (ORDER BY {KEY_ORDER}) AS INTEGER)
           AS CUST_KEY
  FROM changes WHERE CHANGE_CODE IN (1, 3)
),
new_versions AS (
  SELECT CUST_KEY, CUST_ID, {", ".join(ATTRS)}, EXISTING_CUST_KEY, 'Y' AS CURR_FLAG,
         {RUN_DATE} AS EFF_DATE, {HIGH_DATE} AS EXP_DATE
  FROM keyed
),
dim_after AS (
  SELECT d.CUST_KEY, d.CUST_ID, {", ".join("d." + c for c in ATTRS)}, d.EFF_DATE,
         COALESCE(e.EXP_DATE, d.EXP_DATE) AS EXP_DATE, COALESCE(e.CURR_FLAG, d.CURR_FLAG) AS CURR_FLAG
  FROM dimension d LEFT JOIN (SELECT DISTINCT * FROM expire) e ON d.CUST_KEY = e.CUST_KEY
  UNION ALL
  SELECT {", ".join(DIM_COLS)} FROM new_versions
),
dim_post AS (SELECT * FROM dim_after WHERE CURR_FLAG = 'Y')"""


def _lookup_ctes(dim: str, suffix: str) -> str:
    dim_cols = ", ".join(f"d.{c}" for c in DIM_COLS if c != "CUST_ID")
    sales_cols = ", ".join(f"s.{c}" for c in SALES_COLS)
    return f"""
joined{suffix} AS (
  SELECT {sales_cols}, {dim_cols} FROM sales_txn s LEFT JOIN {dim} d ON s.CUST_ID = d.CUST_ID
),
enriched{suffix} AS (SELECT * FROM joined{suffix} WHERE CUST_KEY IS NOT NULL),
lookup_reject{suffix} AS (
  SELECT TXN_ID, CUST_ID, 'CUSTOMER_NOT_FOUND_IN_DIMENSION' AS ERROR_REASON FROM joined{suffix} WHERE CUST_KEY IS NULL
),
dq_pass{suffix} AS (
  SELECT * FROM enriched{suffix}
  WHERE CUST_ID IS NOT NULL AND AMOUNT > 0 AND QTY > 0 AND TXN_DATE IS NOT NULL
),
dq_reject{suffix} AS (
  SELECT TXN_ID, CUST_ID,
         CASE WHEN CUST_ID IS NULL THEN 'MISSING_CUST_ID' WHEN AMOUNT <= 0 THEN 'NON_POSITIVE_AMOUNT'
              WHEN QTY <= 0 THEN 'NON_POSITIVE_QTY' ELSE 'MISSING_TXN_DATE' END AS ERROR_REASON
  FROM enriched{suffix}
  WHERE CUST_ID IS NULL OR AMOUNT <= 0 OR QTY <= 0 OR TXN_DATE IS NULL
),
dq_unclassified{suffix} AS (
  SELECT * FROM enriched{suffix}
  WHERE NOT COALESCE(CUST_ID IS NOT NULL AND AMOUNT > 0 AND QTY > 0 AND TXN_DATE IS NOT NULL, FALSE)
    AND NOT COALESCE(CUST_ID IS NULL OR AMOUNT <= 0 OR QTY <= 0 OR TXN_DATE IS NULL, FALSE)
),
fact{suffix} AS (
  SELECT CUST_KEY, PRODUCT_ID, STORE_ID, TXN_DATE,
         CAST(sum(QTY) AS INTEGER) AS TOTAL_QTY,
         CAST(sum(AMOUNT) AS DECIMAL(15,2)) AS TOTAL_AMOUNT,
         CAST(count(TXN_ID) AS INTEGER) AS TXN_COUNT,
         CAST(CAST((2 * CAST(sum(UNIT_PRICE) * 100 AS BIGINT) + count(UNIT_PRICE)) // (2 * count(UNIT_PRICE))
                   AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS AVG_UNIT_PRICE
  FROM dq_pass{suffix} GROUP BY CUST_KEY, PRODUCT_ID, STORE_ID, TXN_DATE
),
errors{suffix} AS (
  SELECT TXN_ID, CUST_ID, ERROR_REASON, {RUN_TS} AS ERROR_TIMESTAMP, {RUN_DATE} AS RUN_DATE
  FROM (SELECT * FROM lookup_reject{suffix} UNION ALL SELECT * FROM dq_reject{suffix})
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


FULL = _with(ADAPTERS, _changes_cte(PLAIN_COMPARE), SCD, _lookup_ctes("dim_current", "_pre"),
             _lookup_ctes("dim_post", "_post"))


def _on_full(select: str) -> str:
    return f"{FULL}\n{select}"


AUDIT_ORDER = [
    ("customer_delta", "customer_delta"), ("sales_txn", "sales_txn"), ("dimension_current", "dim_current"),
    ("changes", "changes"), ("expired", "expire"), ("new_versions", "new_versions"),
    ("dimension_after", "dim_after"), ("lookup_rejects", "lookup_reject_post"), ("dq_pass", "dq_pass_post"),
    ("dq_rejects", "dq_reject_post"), ("dq_unclassified", "dq_unclassified_post"), ("fact", "fact_post"),
    ("errors", "errors_post"),
]
AUDIT = " UNION ALL ".join(
    f"SELECT '{name}' AS OUTPUT, count(*) AS ROW_COUNT FROM {cte}" for name, cte in AUDIT_ORDER)

BOOTSTRAP = f"""
SELECT CAST(row_number() OVER (ORDER BY {KEY_ORDER}) AS INTEGER) AS CUST_KEY, CUST_ID, {", ".join(ATTRS)},
       {RUN_DATE} AS EFF_DATE, {HIGH_DATE} AS EXP_DATE, 'Y' AS CURR_FLAG
FROM (SELECT *, CAST(NULL AS INTEGER) AS EXISTING_CUST_KEY FROM customer_delta WHERE CUST_ID IS NOT NULL)"""

DELETES = f"""
change_del AS (
  SELECT CASE WHEN b.CUST_KEY IS NULL THEN 1 WHEN a.CUST_ID IS NULL THEN 2
              WHEN {" OR ".join(PLAIN_COMPARE.format(c=c) for c in ATTRS)} THEN 3 ELSE 0 END AS CHANGE_CODE,
         COALESCE(a.CUST_ID, b.CUST_ID) AS CUST_ID,
         {", ".join(f"CASE WHEN a.CUST_ID IS NULL THEN b.{c} ELSE a.{c} END AS {c}" for c in ATTRS)},
         b.CUST_KEY AS EXISTING_CUST_KEY
  FROM customer_delta a FULL OUTER JOIN dim_current b ON a.CUST_ID = b.CUST_ID
)"""

CHANGE_COLS = ", ".join(["CHANGE_CODE", "CUST_ID", *ATTRS, "EXISTING_CUST_KEY"])
FEED_COLS = ["CUST_ID", *ATTRS, "SOURCE_SYSTEM", "EFF_DATE"]
LATEST = f"""
SELECT {", ".join(FEED_COLS)} FROM (
  SELECT *, row_number() OVER (
           PARTITION BY CUST_ID
           ORDER BY {", ".join(f"{c} DESC NULLS LAST" for c in ["EFF_DATE", *ATTRS, "SOURCE_SYSTEM"])}) AS rn
  FROM customer_delta)
WHERE rn = 1"""



def _replay_day(day: int, run_date: str, expiry: str, segment: str, before: str) -> str:
    """One day of a replay: the latest feed row of each customer against the current rows of ``before``."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["EFF_DATE", *ATTRS, "SOURCE_SYSTEM"])
    attrs = ", ".join("a." + c for c in ATTRS)
    differs = " OR ".join(PLAIN_COMPARE.format(c=c) for c in ATTRS)
    return f"""
feed{day} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CUST_ID ORDER BY {order}) AS rn
                 FROM (SELECT * REPLACE ({segment} AS SEGMENT) FROM customer_delta)) WHERE rn = 1 AND CUST_ID IS NOT NULL
),
edit{day} AS (
  SELECT a.CUST_ID, {attrs}, b.CUST_KEY AS EXISTING_CUST_KEY
  FROM feed{day} a LEFT JOIN (SELECT * FROM {before} WHERE CURR_FLAG = 'Y') b ON a.CUST_ID = b.CUST_ID
  WHERE b.CUST_KEY IS NULL OR {differs}
),
day{day} AS (
  SELECT CUST_KEY, CUST_ID, {", ".join(ATTRS)}, EFF_DATE,
         CASE WHEN CUST_KEY IN (SELECT EXISTING_CUST_KEY FROM edit{day} WHERE EXISTING_CUST_KEY IS NOT NULL)
              THEN {expiry} ELSE EXP_DATE END AS EXP_DATE,
         CASE WHEN CUST_KEY IN (SELECT EXISTING_CUST_KEY FROM edit{day} WHERE EXISTING_CUST_KEY IS NOT NULL)
              THEN 'N' ELSE CURR_FLAG END AS CURR_FLAG
  FROM {before}
  UNION ALL
  SELECT CAST(coalesce((SELECT max(CUST_KEY) FROM {before}), 0) + row_number() OVER (ORDER BY {KEY_ORDER}) AS INTEGER),
         CUST_ID, {", ".join(ATTRS)}, {run_date}, {HIGH_DATE}, 'Y' FROM edit{day}
)"""


SORT_KEYS = ["CUST_KEY", "PRODUCT_ID", "STORE_ID"]
SALES_COLS = ["TXN_ID", "CUST_ID", "PRODUCT_ID", "STORE_ID", "CHANNEL", "TXN_DATE", "QTY", "UNIT_PRICE", "AMOUNT"]
DIM_COLS = ["CUST_KEY", *ATTRS, "EFF_DATE", "EXP_DATE", "CURR_FLAG"]
TIE_BREAK = [c for c in [*SALES_COLS, *DIM_COLS] if c not in SORT_KEYS]
SORTED = f"""
SELECT *, row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in [*SORT_KEYS, *TIE_BREAK])}) AS POSITION
FROM dq_pass_pre"""

TWO_DAYS = _with(ADAPTERS, _replay_day(1, RUN_DATE, EXPIRY_DATE, "SEGMENT", "dimension"),
                 _replay_day(2, "DATE '2026-07-29'", RUN_DATE, "CASE WHEN CUST_ID LIKE '%5' THEN 'RAISED' ELSE SEGMENT END",
                             "day1")) + "\nSELECT * FROM day2"

FIRST_DAYS = _with(ADAPTERS, "\nempty_dim AS (SELECT * FROM dimension WHERE FALSE)",
                   _replay_day(1, RUN_DATE, EXPIRY_DATE, "SEGMENT", "empty_dim"),
                   _replay_day(2, "DATE '2026-07-29'", RUN_DATE,
                               "CASE WHEN CUST_ID LIKE '%5' THEN 'RAISED' ELSE SEGMENT END", "day1")) + "\nSELECT * FROM day2"

ORACLE: dict[str, str] = {
    "scan_customer_delta_csv": _with(ADAPTERS) + "\nSELECT * FROM customer_delta",
    "scan_sales_csv": _with(ADAPTERS) + "\nSELECT * FROM sales_txn",
    "dim_current_scan": _on_full(f"SELECT {', '.join(DIM_COLS)} FROM dim_after WHERE CURR_FLAG = 'Y'"),
    "dim_bootstrap_first_load": _with(ADAPTERS) + BOOTSTRAP,
    "lookup_enrich": _on_full("SELECT * FROM enriched_pre"),
    "lookup_reject": _on_full("SELECT * FROM lookup_reject_pre"),
    "lookup_enrich_post_load": _on_full("SELECT * FROM enriched_post"),
    "lookup_reject_post_load": _on_full("SELECT * FROM lookup_reject_post"),
    "dq_pass": _on_full("SELECT * FROM dq_pass_pre"),
    "dq_reject": _on_full("SELECT * FROM dq_reject_pre"),
    "dq_unclassified": _on_full("SELECT * FROM dq_unclassified_pre"),
    "dq_reject_unjoined": _with(ADAPTERS) + """
SELECT TXN_ID, CUST_ID,
       CASE WHEN CUST_ID IS NULL THEN 'MISSING_CUST_ID' WHEN AMOUNT <= 0 THEN 'NON_POSITIVE_AMOUNT'
            WHEN QTY <= 0 THEN 'NON_POSITIVE_QTY' ELSE 'MISSING_TXN_DATE' END AS ERROR_REASON
FROM sales_txn WHERE CUST_ID IS NULL OR AMOUNT <= 0 OR QTY <= 0 OR TXN_DATE IS NULL""",
    "change_capture": _on_full("SELECT * FROM changes"),
    "change_capture_null_safe": _with(ADAPTERS, _changes_cte(NULL_SAFE_COMPARE)) + "\nSELECT * FROM changes",
    "change_capture_with_deletes": _with(ADAPTERS, DELETES)
    + f"\nSELECT {CHANGE_COLS} FROM change_del WHERE CHANGE_CODE <> 0 AND CUST_ID IS NOT NULL",
    "feed_latest_per_key": _with(ADAPTERS) + LATEST,
    "surrogate_keys": _on_full(f"SELECT {CHANGE_COLS}, CUST_KEY FROM keyed"),
    "surrogate_keys_distributed": _on_full(f"SELECT {CHANGE_COLS}, CUST_KEY FROM keyed"),
    "scd2_expire": _on_full("SELECT * FROM expire"),
    "scd2_new_versions": _on_full("SELECT * FROM new_versions"),
    "dim_after_load": _on_full("SELECT * FROM dim_after"),
    "dim_two_day": TWO_DAYS,
    "dim_catalog_two_day": FIRST_DAYS,
    "dim_versioned_roundtrip": _on_full("SELECT * FROM dim_after"),
    "sales_fact_aggregate": _on_full("SELECT * FROM fact_pre"),
    "sales_sorted": _on_full("SELECT * FROM dq_pass_pre ORDER BY CUST_KEY, PRODUCT_ID, STORE_ID"),
    "sales_sorted_files": _on_full(SORTED),
    "sales_fact_post_load": _on_full("SELECT * FROM fact_post"),
    "error_funnel": _on_full("SELECT * FROM errors_post"),
    "fact_append_roundtrip": _on_full("SELECT * FROM fact_post"),
    "error_log_roundtrip": _on_full("SELECT * FROM errors_post"),
    "load_audit": _on_full(AUDIT),
    "load_audit_observed": _on_full(AUDIT),
}
