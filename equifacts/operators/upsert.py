"""Upserts that never let NULL overwrite a value and that log every change.

Both sides are unique by key when they meet (the batch is folded first), so the full outer
join shuffles each side once and no key is larger than two rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.operators.merge import fold_rows

OP, CHANGED, DIRTY = "_op", "_changed", "_dirty"


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], values: list[str], run_ts,
           order: list[str] | None = None, insert_reports: str = "non_null",
           stamps: dict[str, str] | None = None) -> DataFrame:
    """The new state of ``target`` with an operation and the changed columns per row.

    ``order`` folds several incoming rows of a key: later rows win column by column.
    ``insert_reports`` is "non_null" or "all": which columns a new row lists as changed.
    ``stamps`` maps a time column to when it is set: "created", "on_change", "always"
    (for every row in the batch), or the name of a boolean column of ``incoming``.
    Further columns of ``target`` are carried along.
    ``_op`` is "insert", "update", "same" (in the batch, nothing new) or "keep"; ``_dirty`` tells
    whether any column differs from what is stored, a stamp included.
    """
    stamps = stamps or {}
    flags = [s for s in stamps.values() if s not in ("created", "on_change", "always")]
    batch = incoming.where(has_keys(keys))
    if order is not None:
        batch = fold_rows(batch, keys, [*values, *flags], order)
    carried = [c for c in target.columns if c not in [*keys, *values, *stamps]]
    old = target.select(
        *keys, *[F.col(c).alias(f"_old_{c}") for c in [*values, *stamps, *carried]],
        F.lit(True).alias("_stored"))
    new = batch.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in values],
        *[F.col(f).alias(f"_flag_{f}") for f in flags], F.lit(True).alias("_given"))
    both = old.join(new, keys, "full_outer")

    stored, given = F.col("_stored").isNotNull(), F.col("_given").isNotNull()
    differs = {
        c: F.col(f"_new_{c}").isNotNull()
        & ~F.col(f"_new_{c}").eqNullSafe(F.col(f"_old_{c}")) for c in values}
    listed = {
        c: (d | ~stored) & given if insert_reports == "all" else d for c, d in differs.items()}
    changed = F.sort_array(F.array_compact(
        F.array(*[F.when(d, F.lit(c)) for c, d in listed.items()])))
    marked = both.withColumn(CHANGED, changed).withColumn(
        OP, F.when(~given, "keep").when(~stored, "insert")
        .when(F.size(CHANGED) > 0, "update").otherwise("same"))

    op = F.col(OP)
    fires = {"created": op == "insert", "on_change": op.isin("insert", "update"),
             "always": given}
    now = run_ts if hasattr(run_ts, "isNull") else F.lit(run_ts).cast("timestamp")

    def stamp(column, when):
        due = fires.get(when, F.coalesce(F.col(f"_flag_{when}"), F.lit(False)) & given)
        return F.when(due, now).otherwise(F.col(f"_old_{column}"))

    stamped = marked.withColumns({f"_at_{c}": stamp(c, w) for c, w in stamps.items()})
    dirty = op.isin("insert", "update")
    for c in stamps:
        dirty = dirty | ~F.col(f"_at_{c}").eqNullSafe(F.col(f"_old_{c}"))
    return stamped.select(
        *keys, *[F.coalesce(f"_new_{c}", f"_old_{c}").alias(c) for c in values],
        *[F.col(f"_old_{c}").alias(c) for c in carried],
        *[F.col(f"_at_{c}").alias(c) for c in stamps], OP, CHANGED, dirty.alias(DIRTY))


def has_keys(keys: list[str]):
    """Rows with a NULL key cannot be stored; the integrity report counts them."""
    found = F.lit(True)
    for k in keys:
        found = found & F.col(k).isNotNull()
    return found


def rows_of(result: DataFrame) -> DataFrame:
    return result.drop(OP, CHANGED, DIRTY)


def change_log(result: DataFrame, keys: list[str]) -> DataFrame:
    """Inserted and updated rows with the names of the changed columns."""
    return result.where(F.col(OP).isin("insert", "update")).select(
        *keys, F.col(OP).alias("op"), F.col(CHANGED).alias("changed"))


def rows_written(result: DataFrame) -> DataFrame:
    return result.agg(F.count_if(F.col(OP).isin("insert", "update")).alias("rows_written"))


def touch(target: DataFrame, processed: DataFrame, key: str, stamps: list[str],
          run_ts) -> DataFrame:
    """Set the time columns of the processed keys."""
    hit = processed.select(key).distinct().withColumn("_hit", F.lit(True))
    now = F.lit(run_ts).cast("timestamp")
    joined = target.join(hit, key, "left")
    return joined.withColumns({
        s: F.when(F.col("_hit"), now).otherwise(F.col(s)) for s in stamps}).drop("_hit")


def with_stubs(parents: DataFrame, children: DataFrame, key: str, stamps: list[str],
               run_ts) -> DataFrame:
    """Parents plus an otherwise empty row for every child key that has none."""
    now = F.lit(run_ts).cast("timestamp")
    missing = children.where(F.col(key).isNotNull()).select(key).distinct().join(
        parents.select(key), key, "left_anti")
    stubs = missing.select(key, *[now.alias(s) for s in stamps])
    return parents.unionByName(stubs, allowMissingColumns=True)
