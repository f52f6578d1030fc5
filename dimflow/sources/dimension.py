"""Customer dimension reads: current rows, full history, empty-target bootstrap.

A dimension kept on a file system uses a versioned layout so a run never
overwrites files anyone reads, and a failed or retried run leaves the previous
version live:

* ``<root>/current/v=<run_date>/attempt=<id>/``      rows a run made current: all of them, or only the new versions
* ``<root>/history/EXPIRED_ON=<date>/attempt=<id>/`` versions closed by that run (append-only)
* ``<root>/_versions/v=<run_date>/a=<id>/``          marker: what the version consists of
* ``<root>/_claims/<number>``                        the commit: the attempt that took the number

A run commits by taking the number after the last one it saw when it read its
inputs, which only one run can do (:func:`dimflow.session.claim`). Of two runs
that read the same state, of one date or of two, the loser fails and none of its
surrogate keys is ever read. Markers without a number are not read.

The marker names the ``parts`` that hold the current rows (one
whole set and the new versions of the runs since) and the closed parts to take
away from them, so a run writes in proportion to its changes, and a run without
changes writes its marker alone. After some runs a whole set is written again.
Markers are append-only too: a re-run of a date adds a newer marker instead of
replacing the old one. Readers take each date's marker of the highest number and
read only the parts that markers name: files of a failed attempt are never listed or read, and
a re-run deletes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow import schemas as S
from dimflow.operators.joins import Size
from dimflow.session import claims

MARKER_SCHEMA = T.StructType([T.StructField("version", T.StringType()),
                              T.StructField("attempt", T.StringType()),
                              T.StructField("next_key", T.LongType()),
                              T.StructField("committed_at", T.TimestampType()),
                              T.StructField("current_rows", T.LongType()),
                              T.StructField("current_bytes", T.LongType()),
                              T.StructField("closed_rows", T.LongType()),
                              T.StructField("parts", T.ArrayType(T.StringType())),
                              T.StructField("minus", T.ArrayType(T.StringType()))])


def read_if_present(reader, path: str) -> DataFrame | None:
    """``reader.parquet(path)``, or None if there is no such path; any other failure is raised."""
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_rows(dim: DataFrame, flag_col: str = "CURR_FLAG", columns: list[str] | None = None) -> DataFrame:
    """Current-row scan of any dimension frame: filter on the flag, project the columns.

    On Parquet both the filter and the projection reach the scan
    (``PushedFilters`` / ``ReadSchema``).
    """
    columns = columns or S.names(S.CUSTOMER_DIM)
    return dim.filter(F.col(flag_col) == F.lit(S.CURRENT_FLAG)).select(*columns)


def empty_dimension(spark: SparkSession) -> DataFrame:
    """What a missing target reads as: an empty dimension, not a failure."""
    return spark.createDataFrame([], S.CUSTOMER_DIM)


@dataclass(frozen=True)
class DimensionStore:
    """Paths of a versioned dimension table under ``root``."""

    root: str

    @property
    def current_dir(self) -> str:
        return f"{self.root.rstrip('/')}/current"

    @property
    def history_dir(self) -> str:
        return f"{self.root.rstrip('/')}/history"

    @property
    def versions_dir(self) -> str:
        return f"{self.root.rstrip('/')}/_versions"

    def current_path(self, version: str, attempt: str) -> str:
        return f"{self.current_dir}/v={version}/attempt={attempt}"

    def closed_path(self, version: str, attempt: str) -> str:
        return f"{self.history_dir}/EXPIRED_ON={version}/attempt={attempt}"

    @property
    def claims_dir(self) -> str:
        return f"{self.root.rstrip('/')}/_claims"

    def marker_path(self, version: str, attempt: str) -> str:
        return f"{self.versions_dir}/v={version}/a={attempt}"

    def markers(self, spark: SparkSession) -> dict[str, dict]:
        """Committed ``{version: marker}``: the newest marker of each run date (a few tiny rows per date).

        Each holds its ``number`` besides; the highest is the state that was read.
        """
        taken = claims(spark, self.claims_dir)  # first: a marker is there before its number is taken
        found = read_if_present(spark.read.schema(MARKER_SCHEMA).option("recursiveFileLookup", "true"),
                                self.versions_dir)
        committed = [r.asDict() | {"number": taken[r["attempt"]]} for r in (found.collect() if found else [])
                     if r["attempt"] in taken]
        return {m["version"]: m for m in sorted(committed, key=lambda m: m["number"])}

    @staticmethod
    def last_number(known: dict[str, dict]) -> int:
        return max((m["number"] for m in known.values()), default=0)

    def _markers(self, spark: SparkSession, known: dict[str, dict] | None) -> dict[str, dict]:
        """``known`` — markers already read in this run (one read serves every lookup below)."""
        return known if known is not None else self.markers(spark)

    def commits(self, spark: SparkSession, known: dict[str, dict] | None = None) -> dict[str, str]:
        """Committed ``{version: attempt}``."""
        return {v: m["attempt"] for v, m in self._markers(spark, known).items()}

    def next_key(self, spark: SparkSession, version: str | None, known: dict[str, dict] | None = None) -> int:
        """First free surrogate key after ``version`` (1 for an empty store), kept in its marker."""
        if version is None:
            return 1
        return int(self._markers(spark, known)[version]["next_key"])

    def current_size(self, spark: SparkSession, version: str | None,
                     known: dict[str, dict] | None = None) -> Size | None:
        """Measured size of ``version``'s current rows, kept in its marker (``None`` if not recorded)."""
        if version is None:
            return Size(0, 0)
        marker = self._markers(spark, known)[version]
        if marker.get("current_rows") is None or marker.get("current_bytes") is None:
            return None
        return Size(int(marker["current_rows"]), int(marker["current_bytes"]))

    def committed_versions(self, spark: SparkSession, known: dict[str, dict] | None = None) -> list[str]:
        return sorted(self.commits(spark, known))

    def base_version(self, spark: SparkSession, run_date: dt.date,
                     known: dict[str, dict] | None = None) -> str | None:
        """The version a run of ``run_date`` builds on: newest committed before it."""
        tag = run_date.isoformat()
        versions = self.committed_versions(spark, known)
        later = [v for v in versions if v > tag]
        if later:
            raise ValueError(
                f"dimension at {self.root} already has versions after {tag}: {later}; "
                "re-run dates in order")
        earlier = [v for v in versions if v < tag]
        return earlier[-1] if earlier else None

    def read_current(self, spark: SparkSession, version: str | None,
                     known: dict[str, dict] | None = None) -> DataFrame:
        if version is None:
            return empty_dimension(spark)
        marker = self._markers(spark, known)[version]
        if not marker["parts"]:
            return empty_dimension(spark)
        rows = spark.read.schema(S.CUSTOMER_DIM).parquet(*[self.current_path(*p.split("/")) for p in marker["parts"]])
        rows = current_rows(rows)
        if marker["minus"]:
            closed = spark.read.schema(S.CUSTOMER_DIM).parquet(
                *[self.closed_path(*p.split("/")) for p in marker["minus"]]).select(S.CUSTOMER_KEY)
            rows = rows.join(closed, S.CUSTOMER_KEY, "left_anti")  # surrogate keys are unique
        return rows.select(*S.names(S.CUSTOMER_DIM))

    def read_history(self, spark: SparkSession, before: dt.date | None = None,
                     known: dict[str, dict] | None = None) -> DataFrame:
        """Closed versions of committed runs, optionally only runs before ``before``."""
        markers = self._markers(spark, known)
        paths = [self.closed_path(v, m["attempt"]) for v, m in sorted(markers.items())
                 if m["closed_rows"] and (before is None or v < before.isoformat())]
        if not paths:
            return empty_dimension(spark)
        return spark.read.schema(S.CUSTOMER_DIM).parquet(*paths).select(*S.names(S.CUSTOMER_DIM))

    def read_all(self, spark: SparkSession, version: str | None = None) -> DataFrame:
        """Full dimension (history + current) as of ``version`` (default: live)."""
        if version is None:
            versions = self.committed_versions(spark)
            version = versions[-1] if versions else None
        if version is None:
            return empty_dimension(spark)
        upto = dt.date.fromisoformat(version) + dt.timedelta(days=1)
        return self.read_history(spark, before=upto).unionByName(self.read_current(spark, version))
