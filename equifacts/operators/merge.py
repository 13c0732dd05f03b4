"""Merging of rows that share a key.

Every step is an aggregate with map-side combining, so a key that holds a large part of
the rows is reduced before it is shuffled, and no key is collected as a whole.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_by_key(df: DataFrame, key: str, attributes: list[str], member: str,
                 order: list[str], members: str = "index_keys") -> DataFrame:
    """One row per key: the attributes of its first row, and its distinct members in the
    order in which they first appear.

    Rows are first reduced to one per (key, member), so the list of a key is as long as
    the number of different members, which is the size of the registry.
    """
    at = F.struct(*order)
    per_member = df.groupBy(key, member).agg(
        F.min(at).alias("_at"), F.min_by(F.struct(*attributes), at).alias("_row"))
    merged = per_member.groupBy(key).agg(
        F.min_by("_row", "_at").alias("_row"),
        F.array_sort(F.collect_list(F.struct("_at", member))).alias("_members"))
    return merged.select(
        key, "_row.*", F.col(f"_members.{member}").alias(members))


def member_names(memberships: DataFrame, key: str, name: str,
                 names: str = "names") -> DataFrame:
    """Names per key, ordered. Rows are made distinct first, which bounds each list by the
    number of different names."""
    return (
        memberships.select(key, name).distinct()
        .groupBy(key).agg(F.sort_array(F.collect_list(name)).alias(names)))


def fold_rows(df: DataFrame, keys: list[str], values: list[str],
              order: list[str]) -> DataFrame:
    """One row per key: for each column the last value in ``order`` that is not NULL."""
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(*keys).agg(*[last_filled(v, at).alias(v) for v in values])


def last_filled(value: str, at: Column) -> Column:
    """``max_by`` skips rows whose ordering is NULL, which leaves out the empty values."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), at))


def explode_members(merged: DataFrame, key: str, registry: DataFrame,
                    members: str = "index_keys") -> DataFrame:
    """Bridge rows of the members that the registry knows, with their display names."""
    rows = merged.select(key, F.explode(members).alias("index_key"))
    return rows.join(registry.select("index_key", "index_name"), "index_key").select(
        key, "index_key", "index_name")
