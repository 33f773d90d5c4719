"""Named queries over the shared test tables, each with its SQL twin."""

from fleetlens.catalog.queries import QUERIES
from fleetlens.catalog.sql import SQL
from fleetlens.catalog.stream_queries import STREAM_QUERIES, STREAM_SQL

__all__ = ["QUERIES", "SQL", "STREAM_QUERIES", "STREAM_SQL"]
