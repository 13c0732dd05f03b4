"""Newest periods per company, by the date the label stands for."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equifacts.functions.text import period_month, period_year
from equifacts.operators.merge import fold_rows


def with_period(df: DataFrame, label: str = "period_label") -> DataFrame:
    return df.withColumns({
        "_year": period_year(F.col(label)), "_month": period_month(F.col(label))})


def newest_first(label: str = "period_label") -> list[Column]:
    return [F.desc("_year"), F.desc("_month"), F.asc(label)]


def latest_periods(df: DataFrame, keys: list[str], n: int,
                   label: str = "period_label") -> DataFrame:
    """The ``n`` newest rows per key, numbered in ``period_rank``.

    The rank filter is applied before the shuffle too, so a long history of one key
    sends at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(label))
    ranked = with_period(df, label).withColumn("period_rank", F.row_number().over(window))
    return ranked.where(F.col("period_rank") <= n)


def latest_period(df: DataFrame, key: str, columns: list[str],
                  label: str = "period_label") -> DataFrame:
    """The newest row per key as one aggregate."""
    dated = with_period(df, label)
    # min over negated parts: newest first, ties by the smaller label.
    at = F.struct((-F.col("_year")).alias("y"), (-F.col("_month")).alias("m"), F.col(label))
    newest = dated.groupBy(key).agg(
        F.min_by(F.struct(label, *columns), at).alias("_row"))
    return newest.select(key, "_row.*")


def order_periods(df: DataFrame, name: str, key: str, label: str = "period_label") -> DataFrame:
    """By company name, the key standing in for an empty one, then newest first."""
    shown = F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(key).cast("string"))
    return df.orderBy(shown, *newest_first(label), F.asc(key))


def merge_latest(state: DataFrame, batch: DataFrame, keys: list[str], n: int, values: list[str],
                 order: list[str], label: str = "period_label") -> DataFrame:
    """The ``n`` newest rows per key of the batch's keys, from those known so far and the batch.

    ``state`` holds what this gave before: at most ``n`` rows a key, whatever the history. The
    label alone says how new a row is, so a row that once fell out never comes back, and a late or
    restated one needs no other than these. A restated row's filled values win over the known
    ones; in the batch, later rows in ``order`` do.
    """
    mine = state.join(batch.select(*keys).distinct(), keys, "left_semi")
    known = mine.select(*keys, label, *values, F.lit(0).alias("_late"), *[
        F.lit(None).cast(batch.schema[c].dataType).alias(f"_{c}") for c in order])
    given = batch.select(*keys, label, *values, F.lit(1).alias("_late"), *[F.col(c).alias(f"_{c}") for c in order])
    folded = fold_rows(known.unionByName(given), [*keys, label], values, ["_late", *[f"_{c}" for c in order]])
    return latest_periods(folded, keys, n, label).drop("_year", "_month", "period_rank")
