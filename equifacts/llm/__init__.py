"""Operators for preparing training data, and their queries on the given tables."""

from equifacts.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
