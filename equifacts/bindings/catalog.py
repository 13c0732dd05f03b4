"""Registry of the queries that run on the given tables, each beside its SQL equivalent."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from equifacts.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Data:
    """The given tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


def query(sql: str | None = None):
    def register(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Data(spark, folder))

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return build

    return register
