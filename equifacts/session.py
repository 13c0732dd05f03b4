"""Session settings the operators rely on, and the shared scratch folder."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Stamps are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # JSON objects with a repeated key keep the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key in a join even when the aggregate after it then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on several key columns takes a side that is dealt by one of them as it is.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Above this size the JVM leaves a generated method uncompiled. Wide extractions reach
    # it; they run faster as several smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Small shuffle partitions are put together up to so many compressed bytes. Rows in memory, as a sort holds
# them, take ten times as much and more; with Spark's own size a task of a join would hold about a gigabyte.
PACKED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PACKED_DEFAULT, PACKED_BYTES = "67108864b", "4m"


def configure(spark: SparkSession) -> SparkSession:
    # A size that the session was given stands.
    if spark.conf.get(PACKED) == PACKED_DEFAULT:
        spark.conf.set(PACKED, PACKED_BYTES)
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Where it is not set, the warehouse serves, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/equifacts/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over a few tasks for each core, however few files and row groups hold them.

    For small rows that much is done with: a scan has a task for so many bytes, not for so much work. A plan
    with long expressions costs a task a twentieth of a second, so there are no more tasks than that.
    """
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(most, max(32, 4 * spark.sparkContext.defaultParallelism)), *df.columns)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches read, and read it back.

    The written table replaces the lineage, so a lost executor costs a re-read
    rather than a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
