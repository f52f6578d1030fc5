"""Tables that the tests of this folder share (imported by name: a second conftest would hide the first)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T
from tests_llm_data import CLASHING, EDGE_ROWS, SMALL


@pytest.fixture(scope="session")
def schema():
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
              T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
              T.StructField("n_chars", T.LongType())]
    return T.StructType(fields + [T.StructField(name, T.StringType()) for name in CLASHING])


@pytest.fixture(scope="session")
def edge_docs(spark, schema):
    return spark.createDataFrame([(*row, *["clash"] * len(CLASHING)) for row in EDGE_ROWS], schema)


@pytest.fixture(scope="session")
def no_docs(spark, schema):
    return spark.createDataFrame([], schema)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").cache()
