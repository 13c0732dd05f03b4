"""Processing of newly landed files, each once, into a stored table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equifacts.sources.tables import Tables


def landed_stream(spark: SparkSession, folder: str, schema, files_per_batch: int | None = None):
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def land(stream: DataFrame, tables: Tables, plan: Callable[[DataFrame], dict[str, DataFrame]], checkpoint: str):
    """Take every landed file in once, into several tables at once, and stop when all are in.

    ``plan`` turns a micro-batch into the changes of each table (``Tables.upserted``, ``replaced``,
    ``removed``). A micro-batch is one commit over all its tables, listed with the stream's id and
    the epoch. The id lives in the checkpoint: a micro-batch replayed after a failure finds itself
    listed and is skipped, or finds nothing of it listed and is done again as a whole, while a new
    checkpoint or another stream is a new writer.
    """
    def take(batch: DataFrame, epoch: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if tables.has_epoch(writer, epoch):
            return
        rows = batch.persist()
        try:
            tables.apply(plan(rows), writer, epoch)
        finally:
            rows.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(take).start())


def upsert_landed(stream: DataFrame, tables: Tables, name: str, values: list[str],
                  order: list[str], checkpoint: str, prepare=None):
    """Upsert every landed file into one table."""
    def plan(batch: DataFrame) -> dict[str, DataFrame]:
        return {name: tables.upserted(
            name, prepare(batch) if prepare else batch, values, F.current_timestamp(), order=order,
            stamps={"updated_at": "on_change"})}

    return land(stream, tables, plan, checkpoint)
