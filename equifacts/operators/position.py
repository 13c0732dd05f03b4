"""Places of rows in a sorted frame."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equifacts.session import stage


def numbered(df: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a frame in its own order, numbered from 1.

    A sorted frame's partitions follow each other, so a row's place is its place in its partition
    after all rows of the partitions before; no task sees more than its own partition.
    """
    placed = stage(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    # A row for each partition, of which there are as many as shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return placed.withColumn("_part", part).join(parts, "_part").withColumn(
        name, F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_first")
