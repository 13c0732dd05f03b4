"""Queries on the given tables."""

from equifacts.bindings import feeds, outputs, pages, periods, reports, runs, store, universe, upserts  # noqa: F401
from equifacts.bindings.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
