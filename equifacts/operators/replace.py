"""Replacement of all rows of a key by a new set."""

from pyspark.sql import DataFrame


def without_keys(rows: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Rows of the other keys; with removed parents this is the cascade to a child table."""
    return rows.join(removed.select(key).distinct(), key, "left_anti")


def replace_given(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Keys with incoming rows get those; keys without any keep what is stored."""
    return without_keys(stored, incoming, key).unionByName(incoming)


def replace_processed(stored: DataFrame, incoming: DataFrame, processed: DataFrame,
                      key: str) -> DataFrame:
    """Processed keys get their incoming rows, or none when there are none."""
    return without_keys(stored, processed, key).unionByName(incoming)
