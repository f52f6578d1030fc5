"""Helpers shared by the training-data operators.

Conventions that hold for every operator of this subpackage:

* operators select the columns they need by name, so further columns, also ones
  whose names clash with an operator's own outputs, are ignored;
* a null text counts as the empty text, an empty table gives an empty result;
* intermediate tables are written to the shared folder named by
  ``spark.checkpoint.dir`` (:func:`staged`), never to a machine-local one.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.session import scratch_path

# The characters that separate words (ASCII white space) and the two ASCII alphabets.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

BITS_PER_CHUNK = 32768  # bits in one value of bitmap_construct_agg
BATCH_BYTES = 4 << 20  # of one Arrow batch on its way to Python


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back: lineage ends there.

    ``tasks``: at most so many tasks write it, for tables whose size the caller knows.
    """
    path = scratch_path(df.sparkSession, name)
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is.

    ``lower`` does just that to a text of ASCII characters, many times faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def filter_bits(keys: int) -> int:
    """Bits of a bitmap for so many keys: some eight a key, between 1 MB and 64 MB in all."""
    return min(1 << 29, max(1 << 23, 1 << (8 * keys).bit_length()))


def bitmap_of(keys: DataFrame, bits: int) -> DataFrame:
    """A set of 64-bit keys (column ``key``) as at most ``bits / 32768`` rows of 4 KB.

    Its size is bounded by ``bits`` whatever the number of keys. A key hashes to
    one bit, so a test may say yes for a key that is not in the set, never no
    for one that is.
    """
    bit = F.pmod(F.col("key"), F.lit(bits)) + 1
    return (keys.select(F.bitmap_bucket_number(bit).alias("__chunk"), F.bitmap_bit_position(bit).alias("__bit"))
            .groupBy("__chunk").agg(F.bitmap_construct_agg("__bit").alias("__bitmap")))


def flag_members(rows: DataFrame, key: Column, bitmap: DataFrame, bits: int, flag: str) -> DataFrame:
    """``rows`` with a boolean column: may ``key`` be in the set of :func:`bitmap_of`?

    Left join to the broadcast bitmap (bounded by ``bits``): no row moves.
    """
    bit = F.pmod(key, F.lit(bits)) + 1
    position = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("__bitmap"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    found = F.getbit(byte.cast("bigint"), (position % 8).cast("int")) == 1
    columns = rows.columns
    return (rows.withColumn("__chunk", F.bitmap_bucket_number(bit)).join(F.broadcast(bitmap), "__chunk", "left")
            .select(*[F.col(f"`{c}`") for c in columns], F.coalesce(found, F.lit(False)).alias(flag)))


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches to Python hold some ``BATCH_BYTES``, unless it names a bound itself.

    Else a batch is 10,000 rows however long their texts are: a task holds it in the JVM, with room to grow, and twice
    in its Python worker. Plans read the setting when they run.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_dimflow_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="dimflow-py-")) / "dimflow.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, Path(root.name) / module.relative_to(root))
    sc.addPyFile(str(target))
    sc._dimflow_shipped = True
