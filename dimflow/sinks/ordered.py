"""Sorted tables whose order outlives the write (O1).

A sort before a plain write is lost on readers: nothing says which file comes
first. Here rows are range-partitioned on the order and sorted inside the
partitions, and each partition is one file (or several in a row), so that every
row of a file stands before every row of the next file by number. Readers may
take the files one after the other, merge without sorting, or skip files and row
groups by their Parquet minima and maxima, which hardly overlap.

No single task sorts the table and no key is held together: the range is taken
over all columns, the sort keys first, and over a row's place among its equals, so a
hot key, or one row repeated a billion times, still spreads over many files.

* NULLs stand first; columns after the keys break ties, so a rerun over the same
  rows writes the same order.
* A table without rows has no files with rows; reading it gives none.
* Columns of any name are kept, except that ``POSITION`` is added by the reader and
  an input column of that name (in any case) is refused, as are repeated names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITION = "POSITION"
PLACE = "_dimflow_place"
FILE, INDEX, SIZE = "_dimflow_file", "_dimflow_index", "_dimflow_size"


def _quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def full_order(columns: list[str], keys: list[str]) -> list[str]:
    """The keys, then every other column in the order of the table."""
    missing = [k for k in keys if k not in columns]
    if missing or len(set(keys)) != len(keys):
        raise ValueError(f"sort keys must be different columns of the table: {keys}")
    return [*keys, *[c for c in columns if c not in keys]]


def with_place(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with each row's place in the sorted partition it comes from: the same set however the task saw its rows."""
    return df.sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())


def in_ranges(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``keys`` (then all other columns), partition by partition.

    Without ``partitions`` AQE sizes them. A row's place among its equals is counted
    after a sort inside the partition it comes from, so that a task repeated after a
    lost executor, which may see its rows in another order, gives equal rows the
    same places and no row changes its range.
    """
    order = [_quoted(c).asc_nulls_first() for c in full_order(df.columns, keys)]
    placed = with_place(df, order)
    ranges = (placed.repartitionByRange(partitions, *order, F.col(PLACE)) if partitions
              else placed.repartitionByRange(*order, F.col(PLACE)))
    return ranges.sortWithinPartitions(*order, F.col(PLACE)).drop(PLACE)


def write_sorted(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> None:
    """Write ``df`` in the order of ``keys`` to a new folder."""
    names = [c.lower() for c in df.columns]
    if POSITION.lower() in names or len(set(names)) != len(names):
        raise ValueError(f"columns must have different names and none be {POSITION}: {df.columns}")
    in_ranges(df, keys, partitions).write.mode("errorifexists").parquet(path)


def _number(file: Column) -> list[Column]:
    """A part file's place: the number of its task, then of the file among the task's files (numbers, not text)."""
    return [F.concat(F.lit("0"), F.regexp_extract(file, pattern, 1)).cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)\.")]


def read_sorted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with ``POSITION``: 1 for the first row of the first file, and so on, whatever the order they arrive in.

    The files' row counts come from a scan that reads no column. What is broadcast
    is one short row for each file, fewer bytes than the list of files that the
    driver holds to plan the scan.
    """
    rows = spark.read.schema(schema).parquet(path).select(
        *[_quoted(c) for c in schema.names], F.col("_metadata.file_name").alias(FILE),
        F.col("_metadata.row_index").alias(INDEX))
    sizes = rows.groupBy(FILE).agg(F.count(F.lit(1)).alias(SIZE))
    before = Window.orderBy(*_number(F.col(FILE))).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(FILE, F.coalesce(F.sum(SIZE).over(before), F.lit(0)).alias(SIZE))
    return (rows.join(F.broadcast(offsets), FILE)
            .select(*[_quoted(c) for c in schema.names], (F.col(SIZE) + F.col(INDEX) + 1).alias(POSITION)))
