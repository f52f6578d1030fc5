"""The five relations of the customer/sales mart, plus the change-set shape.

Column names of the customer/sales mart live here (and in :mod:`dimflow.plans`);
operators take column names as arguments.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the original job: relation shapes, column order,
# column types, the compared attributes, flags and reject reasons.
CUSTOMER_DELTA = T.StructType([
    T.StructField("CUST_ID", T.StringType()),
    T.StructField("CUST_NAME", T.StringType()),
    T.StructField("ADDRESS", T.StringType()),
    T.StructField("CITY", T.StringType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("ZIP", T.StringType()),
    T.StructField("SEGMENT", T.StringType()),
    T.StructField("SOURCE_SYSTEM", T.StringType()),
    T.StructField("EFF_DATE", T.DateType()),
])

SALES_TXN = T.StructType([
    T.StructField("TXN_ID", T.StringType()),
    T.StructField("CUST_ID", T.StringType()),
    T.StructField("PRODUCT_ID", T.StringType()),
    T.StructField("STORE_ID", T.StringType()),
    T.StructField("CHANNEL", T.StringType()),
    T.StructField("TXN_DATE", T.DateType()),
    T.StructField("QTY", T.IntegerType()),
    T.StructField("UNIT_PRICE", T.DecimalType(12, 2)),
    T.StructField("AMOUNT", T.DecimalType(14, 2)),
])

CUSTOMER_DIM = T.StructType([
    T.StructField("CUST_KEY", T.IntegerType()),
    T.StructField("CUST_ID", T.StringType()),
    T.StructField("CUST_NAME", T.StringType()),
    T.StructField("ADDRESS", T.StringType()),
    T.StructField("CITY", T.StringType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("ZIP", T.StringType()),
    T.StructField("SEGMENT", T.StringType()),
    T.StructField("EFF_DATE", T.DateType()),
    T.StructField("EXP_DATE", T.DateType()),
    T.StructField("CURR_FLAG", T.StringType()),
])

SALES_FACT = T.StructType([
    T.StructField("CUST_KEY", T.IntegerType()),
    T.StructField("PRODUCT_ID", T.StringType()),
    T.StructField("STORE_ID", T.StringType()),
    T.StructField("TXN_DATE", T.DateType()),
    T.StructField("TOTAL_QTY", T.IntegerType()),
    T.StructField("TOTAL_AMOUNT", T.DecimalType(15, 2)),
    T.StructField("TXN_COUNT", T.IntegerType()),
    T.StructField("AVG_UNIT_PRICE", T.DecimalType(12, 2)),
])

ERROR_LOG = T.StructType([
    T.StructField("TXN_ID", T.StringType()),
    T.StructField("CUST_ID", T.StringType()),
    T.StructField("ERROR_REASON", T.StringType()),
    T.StructField("ERROR_TIMESTAMP", T.TimestampType()),
    T.StructField("RUN_DATE", T.DateType()),
])

CHANGE_SET = T.StructType([
    T.StructField("CHANGE_CODE", T.IntegerType()),
    T.StructField("CUST_ID", T.StringType()),
    T.StructField("CUST_NAME", T.StringType()),
    T.StructField("ADDRESS", T.StringType()),
    T.StructField("CITY", T.StringType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("ZIP", T.StringType()),
    T.StructField("SEGMENT", T.StringType()),
    T.StructField("EXISTING_CUST_KEY", T.IntegerType()),
])

# Business key, surrogate key and the attributes whose change opens a new version.
CUSTOMER_ID = "CUST_ID"
CUSTOMER_KEY = "CUST_KEY"
TRACKED_ATTRIBUTES = ["CUST_NAME", "ADDRESS", "CITY", "STATE", "ZIP", "SEGMENT"]

# Fact grain and the reject-log projection.
FACT_GRAIN = ["CUST_KEY", "PRODUCT_ID", "STORE_ID", "TXN_DATE"]
FACT_SORT = ["CUST_KEY", "PRODUCT_ID", "STORE_ID"]
REJECT_COLUMNS = ["TXN_ID", "CUST_ID", "ERROR_REASON"]

# Change codes: 0 copy (dropped), 1 insert, 2 delete (only with delete detection), 3 edit.
COPY, INSERT, DELETE, EDIT = 0, 1, 2, 3

# Version flags and the lookup reject reason.
CURRENT_FLAG = "Y"
EXPIRED_FLAG = "N"
CUSTOMER_NOT_FOUND = "CUSTOMER_NOT_FOUND_IN_DIMENSION"


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
