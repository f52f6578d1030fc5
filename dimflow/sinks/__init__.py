"""Sinks: versioned dimension, fact table, error log CSV, sorted tables (JDBC options in sources.jdbc)."""

from dimflow.sinks.ordered import read_sorted, write_sorted
from dimflow.sinks.writers import (
    read_error_log,
    read_fact,
    write_dimension_version,
    write_error_log,
    write_fact,
)

__all__ = ["read_error_log", "read_fact", "read_sorted", "write_dimension_version", "write_error_log", "write_fact",
           "write_sorted"]
