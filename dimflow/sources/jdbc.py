"""A relational mart as source of the current rows and target of a run's outputs.

The current-row read is split into range partitions on the surrogate key, whose
highest value the database is asked for. A run appends its outputs to staging
tables under an attempt id; one transaction then applies them set by set
(:func:`load_statements`), so nothing goes through the driver and a run that
fails or is repeated leaves no half and no second copy. No connection is opened
by building the option maps or the statements.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dimflow import schemas as S

ATTEMPT = "LOAD_ATTEMPT"
EXPIRE_ROWS = T.StructType([f for f in S.CUSTOMER_DIM.fields if f.name in (S.CUSTOMER_KEY, "CURR_FLAG", "EXP_DATE")])


def staging(table: str, part: str = "STAGE") -> str:
    """The staging table beside ``table`` (the name may be quoted)."""
    return f'{table[:-1]}_{part}"' if table.endswith('"') else f"{table}_{part}"


def _type(t: T.DataType) -> str:
    return {T.IntegerType: "INTEGER", T.DateType: "DATE"}.get(type(t)) or (
        f"NUMERIC({t.precision}, {t.scale})" if isinstance(t, T.DecimalType) else "VARCHAR(4000)")


def create_statements(dimension: str, fact: str, commits: str) -> list[str]:
    """Statements that make every table of the mart that is not there yet."""
    def table(name: str, schema: T.StructType, *more: str) -> str:
        columns = [f'"{f.name}" {_type(f.dataType)}' for f in schema.fields]
        return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join([*columns, *more])})"

    attempt = f'"{ATTEMPT}" VARCHAR(64)'
    return [table(dimension, S.CUSTOMER_DIM, f'PRIMARY KEY ("{S.CUSTOMER_KEY}")'), table(fact, S.SALES_FACT),
            table(staging(dimension), S.CUSTOMER_DIM, attempt), table(staging(dimension, "EXPIRE"), EXPIRE_ROWS, attempt),
            table(staging(fact), S.SALES_FACT, attempt),
            f'CREATE TABLE IF NOT EXISTS {commits} ("RUN_DATE" VARCHAR(10) PRIMARY KEY, {attempt}, "FIRST_KEY" INTEGER)']


def load_statements(dimension: str, fact: str, commits: str, attempt: str, run_tag: str, first_key: int,
                    rows: dict[str, int]) -> Iterator[tuple[str, int]]:
    """The statements of one transaction that applies a staged attempt, each with the rows it must change.

    First the run date is taken, provided that the next key is still
    ``first_key``. A task that was repeated may have staged its rows twice:
    they are equal, and ``DISTINCT`` counts them once.
    """
    names = lambda schema: ", ".join(f'"{n}"' for n in S.names(schema))
    mine = f"\"{ATTEMPT}\" = '{attempt}'"
    yield (f"INSERT INTO {commits} SELECT '{run_tag}', '{attempt}', {int(first_key)} FROM "
           f'(SELECT coalesce(max("{S.CUSTOMER_KEY}"), 0) + 1 AS k FROM {dimension}) AS top WHERE k = {int(first_key)}'), 1
    if rows["expire"]:
        closing = staging(dimension, "EXPIRE")
        yield (f'UPDATE {dimension} SET "CURR_FLAG" = e."CURR_FLAG", "EXP_DATE" = e."EXP_DATE" FROM '
               f"(SELECT DISTINCT {names(EXPIRE_ROWS)} FROM {closing} WHERE {mine}) AS e "
               f'WHERE {dimension}."{S.CUSTOMER_KEY}" = e."{S.CUSTOMER_KEY}"'), -1
    for part, table, schema in (("dimension", dimension, S.CUSTOMER_DIM), ("fact", fact, S.SALES_FACT)):
        if rows[part]:
            yield (f"INSERT INTO {table} ({names(schema)}) SELECT DISTINCT {names(schema)} FROM {staging(table)} "
                   f"WHERE {mine}"), rows[part]
    for part, table in (("dimension", staging(dimension)), ("expire", staging(dimension, "EXPIRE")),
                        ("fact", staging(fact))):
        if rows[part]:
            yield f"DELETE FROM {table} WHERE {mine}", -1


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    batch_size: int = 10_000

    def base_options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}

    def write_options(self, table: str) -> dict[str, str]:
        return {**self.base_options(), "dbtable": table, "batchsize": str(self.batch_size)}

    def current_dim_read_options(self, table: str, lower_key: int, upper_key: int, num_partitions: int) -> dict[str, str]:
        """Options for reading the current rows in ``num_partitions`` ranges of the surrogate key."""
        if num_partitions < 1 or upper_key < lower_key:
            raise ValueError("a partitioned read needs key bounds in order and at least one partition")
        cols = ", ".join(f'"{c}"' for c in S.names(S.CUSTOMER_DIM))
        query = f"(SELECT {cols} FROM {table} WHERE \"CURR_FLAG\" = '{S.CURRENT_FLAG}') AS dim_current"
        return {**self.base_options(), "dbtable": query, "partitionColumn": S.CUSTOMER_KEY,
                "lowerBound": str(lower_key), "upperBound": str(upper_key), "numPartitions": str(num_partitions)}

    def next_key_options(self, table: str) -> dict[str, str]:
        """Options of a one-row read: the database finds the highest key, of closed versions too."""
        return {**self.base_options(),
                "query": f'SELECT coalesce(max("{S.CUSTOMER_KEY}"), 0) + 1 AS "NEXT_KEY" FROM {table}'}

    def committed_options(self, commits: str, run_tag: str) -> dict[str, str]:
        return {**self.base_options(), "query": f"SELECT \"RUN_DATE\" FROM {commits} WHERE \"RUN_DATE\" = '{run_tag}'"}

    def read(self, spark: SparkSession, options: dict[str, str]) -> DataFrame:
        return spark.read.format("jdbc").options(**options).load()

    def read_current_dim(self, spark: SparkSession, table: str, lower_key: int, upper_key: int,
                         num_partitions: int) -> DataFrame:
        return self.read(spark, self.current_dim_read_options(table, lower_key, upper_key, num_partitions))

    def next_key(self, spark: SparkSession, table: str) -> int:
        return int(self.read(spark, self.next_key_options(table)).first()[0])

    def is_committed(self, spark: SparkSession, commits: str, run_tag: str) -> bool:
        return self.read(spark, self.committed_options(commits, run_tag)).first() is not None

    def append(self, df: DataFrame, table: str) -> None:
        df.write.format("jdbc").options(**self.write_options(table)).mode("append").save()

    def apply(self, spark: SparkSession, statements: Iterator[tuple[str, int]]) -> None:
        """Run ``(statement, rows it must change or -1)`` in one transaction; any other number rolls all back."""
        jvm = spark._jvm
        jvm.java.lang.Class.forName(self.driver, True, jvm.Thread.currentThread().getContextClassLoader())
        login = jvm.java.util.Properties()
        login.setProperty("user", self.user)
        login.setProperty("password", self.password)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, login)
        try:
            connection.setAutoCommit(False)
            run_checked(lambda sql: connection.createStatement().executeUpdate(sql), statements)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()


def run_checked(execute, statements: Iterator[tuple[str, int]]) -> None:
    for sql, expected in statements:
        changed = execute(sql)
        if expected >= 0 and changed != expected:
            raise RuntimeError(f"{changed} rows changed instead of {expected}; nothing was loaded: {sql}")
