"""Sources: dated CSV feeds, the versioned dimension, JDBC options, test adapters."""

from dimflow.sources.catalog import CatalogMart
from dimflow.sources.dimension import DimensionStore, current_rows, empty_dimension
from dimflow.sources.feeds import (
    FEED_OPTIONS,
    feed_path,
    read_customer_delta,
    read_feed,
    read_sales_txn,
    write_feed,
)
from dimflow.sources.jdbc import JdbcTarget

__all__ = [
    "CatalogMart",
    "DimensionStore",
    "FEED_OPTIONS",
    "JdbcTarget",
    "current_rows",
    "empty_dimension",
    "feed_path",
    "read_customer_delta",
    "read_feed",
    "read_sales_txn",
    "write_feed",
]
