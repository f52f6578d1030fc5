"""Session construction for tests/benchmarks and the shared scratch location.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names (a
distributed file system path). Only when a session has none — a local test run —
do we pick a fresh local folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "dimflow", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session configured the way the cluster job expects."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Splits and shuffle partitions of about ``partition_bytes`` keep every task's
    working set in executor memory; AQE coalesces small shuffle partitions and
    splits skewed join partitions at run time. Broadcasts chosen by the job are
    decided by proven row bounds (``RunParams.broadcast_max_rows``), not by
    these settings.
    """
    shuffle_partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.ansi.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    A local folder is created only for a ``local[...]`` master with none
    configured (tests); a cluster session without ``spark.checkpoint.dir`` is an
    error, since a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (e.g. a distributed file system path) "
                               "before running dimflow on a cluster")
        configured = tempfile.mkdtemp(prefix="dimflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/dimflow-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: cuts lineage, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one path made by :func:`scratch_path`, once nothing reads it any more."""
    if "/dimflow-scratch/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    remove(spark, path)


def claim(spark: SparkSession, folder: str, number: int, owner: str) -> bool:
    """Put ``owner`` under ``number`` in ``folder`` unless the number is taken: of several runs one gets it.

    The file is written aside and renamed without overwriting, so it appears
    whole or not at all; that step is as atomic as the file system's rename.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    folder = folder.rstrip("/")
    target, aside = fs.Path(f"{folder}/{number:012d}"), fs.Path(f"{folder}/.{owner}-{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(aside, False)
    try:
        out.write(f"{number} {owner}\n".encode())
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf).rename(aside, target, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
            raise
        aside.getFileSystem(conf).delete(aside, False)
        return False


def claims(spark: SparkSession, folder: str) -> dict[str, int]:
    """``{owner: number}`` of all numbers taken in ``folder`` (a line each; none if there is no such folder)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return {}
    lines = [r["value"].split(" ", 1) for r in spark.read.text(folder).collect()]
    return {owner: int(number) for number, owner in lines}


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
