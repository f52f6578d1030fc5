"""The mart as Parquet tables of the session's catalog, for users who work by table names.

The tables are made if they are not there, so the first run of an empty catalog
is like any other. All are partitioned by run date, and a run overwrites its
date's partitions only, so a run that failed half-way is mended by running its
date again. The dimension's table only ever gets rows added: the versions a run
opened and, again as whole rows, those it closed; the view beside it shows each
version once. Runs follow each other; two at once are for the versioned store.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow import schemas as S

RUN = "RUN_DATE"


@dataclass(frozen=True)
class CatalogMart:
    database: str
    location: str | None = None  # folder of the database, if not the warehouse's default

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    @property
    def dimension_rows(self) -> str:
        return self._name("CUSTOMER_DIM_ROWS")

    @property
    def dimension(self) -> str:
        return self._name("CUSTOMER_DIM")

    @property
    def fact(self) -> str:
        return self._name("SALES_FACT")

    @property
    def errors(self) -> str:
        return self._name("SALES_ERRORS")

    def ensure(self, spark: SparkSession) -> None:
        """Make the database, the tables and the view that are not there yet."""
        at = f" LOCATION '{self.location}'" if self.location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{at}")
        for table, schema in ((self.dimension_rows, S.CUSTOMER_DIM), (self.fact, S.SALES_FACT), (self.errors, S.ERROR_LOG)):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != RUN)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{RUN}` date) USING parquet PARTITIONED BY (`{RUN}`)")
        columns = ", ".join(f"`{c}`" for c in S.names(S.CUSTOMER_DIM))
        closed = f"(SELECT `{S.CUSTOMER_KEY}` FROM {self.dimension_rows} WHERE `CURR_FLAG` = '{S.EXPIRED_FLAG}')"
        spark.sql(f"CREATE VIEW IF NOT EXISTS {self.dimension} AS SELECT {columns} FROM {self.dimension_rows} r "
                  f"WHERE `CURR_FLAG` = '{S.EXPIRED_FLAG}' OR NOT EXISTS (SELECT 1 FROM {closed} c "
                  f"WHERE c.`{S.CUSTOMER_KEY}` = r.`{S.CUSTOMER_KEY}`)")

    def read_dimension(self, spark: SparkSession, before: dt.date) -> DataFrame:
        """Every version as of the runs before ``before``, once; run dates have to follow each other."""
        rows = spark.table(self.dimension_rows)
        later = [r[0] for r in rows.where(F.col(RUN) > F.lit(before)).select(RUN).distinct().collect()]  # run dates
        if later:
            raise ValueError(f"{self.dimension_rows} already has runs after {before}: {later}; re-run dates in order")
        rows = rows.where(F.col(RUN) < F.lit(before)).select(*S.names(S.CUSTOMER_DIM))
        closed = rows.where(F.col("CURR_FLAG") == F.lit(S.EXPIRED_FLAG))
        opened = rows.where(F.col("CURR_FLAG") == F.lit(S.CURRENT_FLAG))
        return closed.unionByName(opened.join(closed.select(S.CUSTOMER_KEY), S.CUSTOMER_KEY, "left_anti"))

    def overwrite(self, rows: DataFrame, table: str, schema: T.StructType, run_date: dt.date) -> None:
        """Put ``rows`` in the place of the run date's rows of ``table``; ``rows`` must not read that table."""
        rows.select(*[c for c in S.names(schema) if c != RUN]).createOrReplaceTempView("_dimflow_insert")
        rows.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{RUN}` = DATE'{run_date.isoformat()}') "
                              "SELECT * FROM _dimflow_insert")
