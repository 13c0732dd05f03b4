"""Helpers that the operators of this subpackage share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equifacts.session import configure

GAP = r"[\x20\x09-\x0D]+"
FOLDS = 5


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no model learns from; a null id belongs to it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
