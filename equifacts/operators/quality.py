"""Errors, missing fields and integrity violations as tables."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per key the empty fields, in the declared order; complete rows are left out."""
    empty = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    return rows.select(key, empty.alias("fields")).where(F.size("fields") > 0)


def missing_feeds(keys: DataFrame, rows: DataFrame, key: str, kind: str,
                  kinds: dict[str, str]) -> DataFrame:
    """(key, field) for every key that has no row of a kind; ``kinds`` names the field.

    Rows are counted per key before the join, so it meets one row per key.
    """
    counts = rows.groupBy(key).agg(
        *[F.count_if(F.col(kind) == k).alias(f"_{k}") for k in kinds])
    joined = keys.select(key).join(counts, key, "left")
    absent = [F.when(F.coalesce(F.col(f"_{k}"), F.lit(0)) == 0, F.lit(name))
              for k, name in kinds.items()]
    return joined.select(key, F.explode(F.array_compact(F.array(*absent))).alias("field"))


def error_rows(rows: DataFrame, key: str, stage: str, reason: Column, run_ts,
               name: str | None = None) -> DataFrame:
    """Error rows for the rows whose ``reason`` is not NULL."""
    return rows.withColumn("message", reason).where(F.col("message").isNotNull()).select(
        F.col(key).alias("nse_symbol"),
        (F.col(name) if name else F.lit(None).cast("string")).alias("company_name"),
        F.lit(stage).alias("stage"), "message",
        F.lit(run_ts).cast("timestamp").alias("occurred_at"))


def split_errors(rows: DataFrame, key: str, stage: str, reason: Column, run_ts,
                 name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows and error rows; every row is in exactly one of them."""
    return rows.where(reason.isNull()), error_rows(rows, key, stage, reason, run_ts, name)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def errors_and_missing(errors: DataFrame, missing: DataFrame) -> DataFrame:
    """Errors first, then one row per key with its missing fields, by key."""
    listed = missing.select(
        "nse_symbol", F.lit(None).cast("string").alias("company_name"),
        F.lit("missing-fields").alias("stage"), F.array_join("fields", ", ").alias("message"),
        F.lit(None).cast("timestamp").alias("occurred_at"), F.lit(1).alias("part"))
    return errors.withColumn("part", F.lit(0)).unionByName(listed)


def _rule(name: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(name).alias("rule"), F.col("violations").cast("long"))


def unique_rule(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    repeated = df.groupBy(*keys).count().where(F.col("count") > 1)
    return _rule(name, repeated.agg(F.count("*").alias("violations")))


def not_null_rules(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows with a NULL per column in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(c).alias("violations"))
             for c, name in columns.items()]
    return counts.select(F.inline(F.array(*pairs)))


def reference_rule(child: DataFrame, key: str, parent: DataFrame, parent_key: str,
                   name: str) -> DataFrame:
    """Child rows whose key has no parent, counted per key before the join."""
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key).alias(key))
    orphans = per_key.join(parents, key, "left_anti")
    return _rule(name, orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")))


def unknown_keys(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Requested keys that are not known."""
    return requested.select(key).distinct().join(known.select(key), key, "left_anti")


@dataclass(frozen=True)
class Rule:
    """What rows of a table must keep: a condition, or a parent with their key.

    ``holds`` is an SQL condition on the table's columns; a row of which it is not true breaks the
    rule. With ``parent``, rows whose ``key`` no row of ``parent`` has as ``parent_key`` break it.
    """

    name: str
    table: str
    holds: str | None = None
    key: str | None = None
    parent: str | None = None
    parent_key: str | None = None


def broken_rules(rows: DataFrame, rules: list[Rule], parents: dict[str, DataFrame], op: str,
                 delete: str) -> DataFrame:
    """The rows with ``broken``, the names of the rules they break; deletions break none.

    Conditions are told in one pass; each parent costs one join on the key.
    """
    broken = [F.when(~F.coalesce(F.expr(r.holds), F.lit(False)), F.lit(r.name)) for r in rules if r.holds]
    for n, rule in enumerate(r for r in rules if r.parent):
        known = parents[rule.parent].select(F.col(rule.parent_key).alias(rule.key), F.lit(True).alias(f"_has_{n}"))
        rows = rows.join(known, rule.key, "left")
        broken.append(F.when(F.col(f"_has_{n}").isNull(), F.lit(rule.name)))
    names = F.array_compact(F.array(*broken))
    marked = rows.withColumn("broken", F.when(F.col(op) == delete, F.array().cast("array<string>")).otherwise(names))
    return marked.drop(*[c for c in marked.columns if c.startswith("_has_")])
