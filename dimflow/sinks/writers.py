"""Writers for the three outputs, each written once per run.

* Dimension — under a fresh attempt id: the new versions (or, from time to time,
  all current rows) and the versions closed by this run, then the marker, then the
  commit, which only one of several runs that read the same state can make.
  Nothing that is being read is overwritten, and a run that dies or loses before
  its commit leaves the previous version live (its files are never read).
* Fact — Parquet under ``LOAD_DATE`` and an attempt id, then a commit marker that
  readers follow, so a run that dies in between leaves no fact rows behind.
  ``append`` matches the original (a re-run appends again); ``replace_run`` puts
  this run's rows in the place of the date's earlier ones.
* Error log — CSV with a header at ``<err_dir>/sales_errors_<run_date>.dat``, a
  directory of part files in a folder by attempt, written even when empty. The
  commit names the attempt that readers follow and then removes the ones before
  it, so a run that fails leaves the date's earlier log.

An output without rows is not committed as data: zero new versions, closed
versions or fact rows add no part for readers to open.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow import schemas as S
from dimflow.operators.joins import row_bytes
from dimflow.sources.dimension import MARKER_SCHEMA, DimensionStore, read_if_present
from dimflow.session import claim, claims, remove
from dimflow.sinks.ordered import in_ranges
from dimflow.sources.feeds import read_feed

LOAD_DATE = "LOAD_DATE"
FACT_MODES = ("append", "replace_run")


class CommitConflict(RuntimeError):
    """Another run has committed since this one read its inputs; run the date again."""


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach row and byte counters that are filled while the write runs (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.coalesce(F.sum(row_bytes(df)), F.lit(0).cast("long")).alias("bytes")), obs


@dataclass(frozen=True)
class StagedVersion:
    """Data files of one run's dimension version, written but not yet committed."""

    version: str
    attempt: str
    current_rows: int
    current_bytes: int
    closed_rows: int
    parts: tuple[str, ...]
    minus: tuple[str, ...]


def _stage_closed(store: DimensionStore, closed: DataFrame, tag: str, attempt: str) -> int:
    # Closed versions are a few rows spread over every split of the dimension:
    # rebalance them (AQE sizes the partitions) instead of writing one tiny file per split.
    hist, obs = _counted(closed.select(*S.names(S.CUSTOMER_DIM)).hint("rebalance"), "dim_closed")
    hist.write.mode("errorifexists").parquet(store.closed_path(tag, attempt))
    return int(obs.get["rows"])


def _stage_rows(store: DimensionStore, rows: DataFrame, tag: str, attempt: str) -> tuple[int, int]:
    cur, obs = _counted(rows.select(*S.names(S.CUSTOMER_DIM)), "dim_current")
    cur.write.mode("errorifexists").parquet(store.current_path(tag, attempt))
    return int(obs.get["rows"]), int(obs.get["bytes"])


def _attempt() -> str:
    return "a" + uuid.uuid4().hex[:16]


def stage_dimension_version(store: DimensionStore, current: DataFrame, closed: DataFrame,
                            run_date: dt.date) -> StagedVersion:
    """Write all current rows and the versions this run closes under a fresh attempt id.

    Nothing reads them until :func:`commit_dimension_version` writes the marker.
    """
    tag, attempt = run_date.isoformat(), _attempt()
    rows, size = _stage_rows(store, current, tag, attempt)
    n_closed = _stage_closed(store, closed, tag, attempt)
    return StagedVersion(tag, attempt, rows, size, n_closed, (f"{tag}/{attempt}",) if rows else (), ())


def stage_dimension_delta(store: DimensionStore, base: dict, new: DataFrame, closed: DataFrame, run_date: dt.date,
                          has_new: bool, has_closed: bool) -> StagedVersion:
    """Write only what this run changes: its new versions beside the parts of ``base``'s marker, and what it closes.

    Without changes nothing is written at all. The recorded bytes are an upper
    bound, the rows exact.
    """
    tag, attempt = run_date.isoformat(), _attempt()
    part = f"{tag}/{attempt}"
    rows, size = _stage_rows(store, new, tag, attempt) if has_new else (0, 0)
    n_closed = _stage_closed(store, closed, tag, attempt) if has_closed else 0
    return StagedVersion(tag, attempt, base["current_rows"] + rows - n_closed, base["current_bytes"] + size, n_closed,
                         (*base["parts"], *([part] if rows else [])), (*base["minus"], *([part] if n_closed else [])))


def commit_dimension_version(spark: SparkSession, store: DimensionStore, staged: StagedVersion,
                             next_key: int, seen: int | None = None) -> dict[str, int]:
    """Commit the staged version: from now on readers see it.

    ``next_key`` — first surrogate key the next run may use; kept in the marker so
    later runs need not scan the dimension for its maximum key. The measured
    size of the current rows goes there too: the next run's broadcast decisions
    need no scan of the dimension either. ``seen`` — the last commit number when
    the run read its inputs (default: the last one now); if it is no longer the
    last, :class:`CommitConflict` is raised and nothing changes.
    """
    marker = spark.createDataFrame(
        [(staged.version, staged.attempt, int(next_key), None, staged.current_rows, staged.current_bytes,
          staged.closed_rows, list(staged.parts), list(staged.minus))],
        MARKER_SCHEMA).withColumn("committed_at", F.current_timestamp()).select(*MARKER_SCHEMA.names)
    marker.coalesce(1).write.mode("errorifexists").parquet(store.marker_path(staged.version, staged.attempt))
    seen = store.last_number(store.markers(spark)) if seen is None else seen
    if not claim(spark, store.claims_dir, seen + 1, staged.attempt):
        raise CommitConflict(f"{store.root}: another run committed after number {seen}; run {staged.version} again")
    return {"dim_current": staged.current_rows, "dim_closed": staged.closed_rows}


def write_dimension_version(store: DimensionStore, current: DataFrame, closed: DataFrame,
                            run_date: dt.date, next_key: int) -> dict[str, int]:
    """Publish one run's dimension: all current rows, closed versions, the marker, the commit."""
    staged = stage_dimension_version(store, current, closed, run_date)
    return commit_dimension_version(current.sparkSession, store, staged, next_key)


FACT_MARKER = T.StructType([T.StructField("load_date", T.DateType()), T.StructField("attempt", T.StringType()),
                            T.StructField("mode", T.StringType()), T.StructField("rows", T.LongType()),
                            T.StructField("committed_at", T.TimestampType())])


@dataclass(frozen=True)
class StagedFact:
    load_date: dt.date
    attempt: str
    rows: int


def _fact_part(path: str, load_date: dt.date, attempt: str) -> str:
    return f"{path.rstrip('/')}/{LOAD_DATE}={load_date.isoformat()}/attempt={attempt}"


def stage_fact(fact: DataFrame, path: str, run_date: dt.date, order: Sequence[str] = ()) -> StagedFact:
    """Write the fact rows under a fresh attempt id; nothing reads them until :func:`commit_fact`.

    ``order`` — columns to keep the attempt's files in order of (:mod:`dimflow.sinks.ordered`).
    """
    attempt = _attempt()
    rows = fact.select(*S.names(S.SALES_FACT))
    out, obs = _counted(in_ranges(rows, list(order)) if order else rows, "fact")
    out.write.mode("errorifexists").parquet(_fact_part(path, run_date, attempt))
    return StagedFact(run_date, attempt, int(obs.get["rows"]))


def commit_fact(spark: SparkSession, path: str, staged: StagedFact, mode: str = "append") -> int:
    """Make a staged fact visible. An append without rows changes nothing and writes no marker."""
    if mode not in FACT_MODES:
        raise ValueError(f"fact mode must be one of {FACT_MODES}")
    if staged.rows or mode == "replace_run":
        marker = spark.createDataFrame([(staged.load_date, staged.attempt, mode, staged.rows, None)], FACT_MARKER)
        marker = marker.withColumn("committed_at", F.current_timestamp()).select(*FACT_MARKER.names)
        marker.coalesce(1).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/_commits/a={staged.attempt}")
    return staged.rows


def write_fact(fact: DataFrame, path: str, run_date: dt.date, mode: str = "append") -> int:
    if mode not in FACT_MODES:
        raise ValueError(f"fact mode must be one of {FACT_MODES}")
    return commit_fact(fact.sparkSession, path, stage_fact(fact, path, run_date), mode)


def read_fact(spark: SparkSession, path: str, run_date: dt.date | None = None) -> DataFrame:
    """Committed fact rows, of one run date or all; none if nothing has been committed."""
    found = read_if_present(spark.read.schema(FACT_MARKER).option("recursiveFileLookup", "true"),
                            f"{path.rstrip('/')}/_commits")
    live: dict[dt.date, list] = {}
    for m in sorted(found.collect() if found else [], key=lambda m: (m["committed_at"], m["attempt"])):
        live[m["load_date"]] = ([] if m["mode"] == "replace_run" else live.get(m["load_date"], [])) + [m]
    parts = [_fact_part(path, day, m["attempt"]) for day, markers in sorted(live.items()) for m in markers
             if m["rows"] and run_date in (None, day)]
    if not parts:
        return spark.createDataFrame([], S.SALES_FACT)
    return spark.read.schema(S.SALES_FACT).parquet(*parts)


def error_log_path(err_dir: str, run_date: dt.date) -> str:
    return f"{err_dir.rstrip('/')}/sales_errors_{run_date.isoformat()}.dat"


@dataclass(frozen=True)
class StagedErrors:
    run_date: dt.date
    attempt: str
    rows: int


def stage_error_log(errors: DataFrame, err_dir: str, run_date: dt.date) -> StagedErrors:
    """Write the error log under a fresh attempt id; nothing reads it until :func:`commit_error_log`."""
    # Rejects are a thin filter over every split of the sales: only they are
    # rebalanced, so the log is a few files of the advisory size, not one per split.
    attempt = _attempt()
    out, obs = _counted(errors.select(*S.names(S.ERROR_LOG)).hint("rebalance"), "errors")
    (out.write.mode("errorifexists")
     .option("header", "true").option("nullValue", "NULL").option("dateFormat", "yyyy-MM-dd")
     .csv(f"{error_log_path(err_dir, run_date)}/attempt={attempt}"))
    return StagedErrors(run_date, attempt, int(obs.get["rows"]))


def _log_commits(spark: SparkSession, path: str) -> dict[str, int]:
    return claims(spark, f"{path}/_commits")


def commit_error_log(spark: SparkSession, err_dir: str, staged: StagedErrors) -> int:
    """Make a staged log the date's log, in the place of an earlier one."""
    path = error_log_path(err_dir, staged.run_date)
    earlier = _log_commits(spark, path)
    number = max(earlier.values(), default=0) + 1
    while not claim(spark, f"{path}/_commits", number, staged.attempt):
        number += 1
    for attempt in earlier:
        remove(spark, f"{path}/attempt={attempt}")
    return staged.rows


def write_error_log(errors: DataFrame, err_dir: str, run_date: dt.date) -> int:
    return commit_error_log(errors.sparkSession, err_dir, stage_error_log(errors, err_dir, run_date))


def read_error_log(spark: SparkSession, err_dir: str, run_date: dt.date) -> DataFrame:
    """The date's committed error log; none if nothing has been committed."""
    path = error_log_path(err_dir, run_date)
    commits = _log_commits(spark, path)
    if not commits:
        return spark.createDataFrame([], S.ERROR_LOG)
    return read_feed(spark, f"{path}/attempt={max(commits, key=commits.get)}", S.ERROR_LOG)
