"""Run parameters, passed explicitly to every operator that needs them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

MIN_HOT_KEY_SHARE = 1e-5  # at most 100,000 hot keys pass through the driver
SNAPSHOTS = ("post_load", "pre_load")


def _as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


@dataclass(frozen=True)
class RunParams:
    """Everything a daily run depends on besides its input tables.

    ``run_ts`` is the audit time stamped on error rows: ``None`` means
    ``current_timestamp()``; a ``'yyyy-MM-dd HH:mm:ss'`` string pins it, which
    makes a run reproducible.

    ``snapshot`` picks which dimension the sales are enriched against:
    ``post_load`` (the dimension after this run's SCD2 changes, as the original
    job effectively does) or ``pre_load`` (the current rows before the run).

    Join and key-assignment knobs:

    * ``broadcast_max_rows`` / ``broadcast_max_bytes`` — a lookup side is
      broadcast only after a measurement (or a bound derived from measured
      inputs) proves it has at most this many rows *and* bytes (UnsafeRow
      footprint, what the driver collects and ships); otherwise it is first
      reduced to the big side's keys, or joined by a salted shuffle.
    * ``hot_key_share`` / ``skew_sample_fraction`` / ``hot_key_hits`` — on the
      shuffle path, keys holding at least ``hot_key_share`` of a sampled big side
      (at most ``1 / hot_key_share`` keys, and at least ``hot_key_hits`` rows of the
      sample) are spread over tasks, each over as many as its share of the shuffle
      partitions. Sampling routes rows, it drops none.
    * ``compact_every`` — after so many daily deltas the dimension store writes a
      whole set of current rows again.
    """

    run_date: dt.date = dt.date(2026, 7, 28)
    high_date: dt.date = dt.date(9999, 12, 31)
    run_ts: str | None = None
    snapshot: str = "post_load"
    null_safe_compare: bool = False
    dedupe_feed: bool = False
    detect_deletes: bool = False
    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 256 << 20
    hot_key_share: float = 1e-4
    skew_sample_fraction: float = 0.01
    hot_key_hits: int = 8
    compact_every: int = 16

    def __post_init__(self) -> None:
        object.__setattr__(self, "run_date", _as_date(self.run_date))
        object.__setattr__(self, "high_date", _as_date(self.high_date))
        if self.snapshot not in SNAPSHOTS:
            raise ValueError(f"snapshot must be one of {SNAPSHOTS}, got {self.snapshot!r}")
        if not MIN_HOT_KEY_SHARE <= self.hot_key_share <= 1:
            raise ValueError(f"hot_key_share must be in [{MIN_HOT_KEY_SHARE}, 1]: it bounds the list of hot keys")
        if self.broadcast_max_rows < 0 or self.broadcast_max_bytes < 0:
            raise ValueError("broadcast bounds must be >= 0")
        if self.hot_key_hits < 1 or self.compact_every < 1:
            raise ValueError("hot_key_hits and compact_every must be >= 1")

    @property
    def expiry_date(self) -> dt.date:
        """Last day an expired version was valid: the day before the run."""
        return self.run_date - dt.timedelta(days=1)

    @property
    def run_tag(self) -> str:
        return self.run_date.isoformat()

    def with_(self, **changes) -> RunParams:
        return replace(self, **changes)
